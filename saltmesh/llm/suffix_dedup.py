"""Removal of repeated byte strings by a sparse suffix sort over common-prefix-aware distributed merges.

A byte goes if a string of LENGTH bytes covers it that also starts anywhere else. Each such string (a window) has an
anchor: the place of the least hash of KMER bytes inside it, leftmost if equal. Equal windows have equal anchors at equal
distances, so only suffixes at anchors need sorting. Neighbouring windows with one anchor are a stretch.

1. Stretches are counted by anchor bytes and content. A stretch that occurs twice is repeated whole.
2. Stretches whose anchor bytes also stand in other stretches may share a part of their windows. Each task sorts its
   suffixes (from the anchor to the end of the stretch), front-codes the run, and deals it by splitters; a task merges
   the runs of its range by a loser tree that knows common prefixes with the last winner and never compares them again.
   The common prefix with both neighbours bounds which windows can be repeated; those are compared by hash. There are
   at most SPLITTERS splitters; beyond that each range is dealt further by its anchor bytes, so that a range stays small
   however many suffixes there are.
3. Anchor bytes with over HOT distinct stretches are dealt window by window instead, with counts combined before the
   shuffle, so that no range holds an unbounded group.

Defined results: null or empty text has n_bytes 0, nothing removed and the hash of no bytes. Texts under LENGTH bytes
stay whole. Equal texts of LENGTH bytes or more are removed whole, repeated rows too; the work grows in proportion to
such rows. Matches never cross documents. Texts over SEGMENT bytes are searched in overlapping segments, and removed from
whole. Extra columns are ignored, whatever their names; an empty table gives an empty result.
"""

from __future__ import annotations

import bisect
import hashlib
import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .bytehash import Prefix, mix
from .shared import drop_tables, free_shuffles, keep_only, last_made, slices, stored, table, tables_made

LENGTH, KMER = 200, 32
#: Distinct stretches of one anchor over which its windows are dealt one by one.
HOT = 2_000
#: Suffixes of a range, splitters at most, and suffixes drawn for each splitter.
RANGE, SPLITTERS, DRAWN = 20_000, 10_000, 8
#: Suffixes that a task sorts at once (about 500 bytes each).
RUN = 30_000
#: Bytes of a text that are searched at once.
SEGMENT = 1 << 20
#: Bits of the place in a buffer, which is some segments long at most; the bits above hold the hash that orders anchors.
PLACE_BITS = 28


def _least(key: np.ndarray, wide: int) -> np.ndarray:
    """Minimum of each wide neighbouring values, by doubling."""
    have = 1
    while 2 * have <= wide:
        key = np.minimum(key[:-have], key[have:])
        have *= 2
    return np.minimum(key[: len(key) - (wide - have)], key[wide - have :]) if wide > have else key


def stretches(raw: list[bytes], length: int = LENGTH, kmer: int = KMER) -> tuple[np.ndarray, ...]:
    """For each stretch: number of its text, start, windows, distance of the anchor, hash of the anchor bytes, hash of the content."""
    data = np.frombuffer(b"".join(raw), np.uint8)
    sizes = np.array([len(r) for r in raw], np.int64)
    empty = np.empty(0, np.int64)
    if len(data) < length:
        return (empty,) * 6
    prefix = Prefix(data)
    at = np.arange(len(data) - kmer + 1)
    khash = prefix.hash(at, at + kmer)
    mask = np.uint64((1 << PLACE_BITS) - 1)
    low = _least((khash & ~mask) | at.astype(np.uint64), length - kmer + 1) & mask
    begin = np.cumsum(sizes) - sizes
    windows = np.maximum(sizes - length + 1, 0)
    text = np.repeat(np.arange(len(raw)), windows)
    if not len(text):
        return (empty,) * 6
    start = np.arange(len(text)) - np.repeat(np.cumsum(windows) - windows, windows) + np.repeat(begin, windows)
    anchor = low[start].astype(np.int64)
    head = np.flatnonzero(np.r_[True, (anchor[1:] != anchor[:-1]) | (text[1:] != text[:-1])])
    count = np.diff(np.r_[head, len(text)])
    first, anchor, text = start[head], anchor[head], text[head]
    content = mix(prefix.hash(first, first + count - 1 + length) + (anchor - first).astype(np.uint64))
    return text, first - begin[text], count, anchor - first, khash[anchor].astype(np.int64), content.astype(np.int64)


def segments(raw: list[bytes], length: int) -> Iterator[list[tuple[int, int, bytes]]]:
    """(number of the text, place, bytes) in lists of about SEGMENT bytes: each window of the texts stands in one segment."""
    part: list[tuple[int, int, bytes]] = []
    size = 0
    for k, data in enumerate(raw):
        for at in range(0, max(1, len(data) - length + 1), SEGMENT):
            part.append((k, at, data[at : at + SEGMENT + length - 1]))
            size += len(part[-1][2])
            if size >= SEGMENT:
                yield part
                part, size = [], 0
    if part:
        yield part


def _arrow(names: str, columns: list, kinds: dict) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays([pa.array(c, kinds.get(n, pa.int64())) for n, c in zip(names.split(), columns, strict=True)], names.split())


def find_stretches(docs: DataFrame, length: int) -> DataFrame:
    """docs (doc, row, text) to (kmer, content, doc, row, start, windows, ahead, times).

    Stretches that a slice of texts holds several times are known to be repeated there and then: the first of them
    stands for all (times is their number), the others have times 0 and need no shuffle to be found out.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        keep_only()
        for batch in batches:
            docs_, rows, done = batch.column(0).to_numpy(), batch.column(1).to_numpy(), 0
            for part in slices(batch.column(2).to_pylist()):
                for some in segments([t.encode() for t in part], length):
                    piece, start, count, ahead, kmer, content = stretches([data for _, _, data in some], length)
                    text = done + np.array([k for k, _, _ in some], np.int64)[piece]
                    start = start + np.array([at for _, at, _ in some], np.int64)[piece]
                    times = np.zeros(len(kmer), np.int32)
                    if len(kmer):
                        order = np.lexsort((content, kmer))
                        head = np.flatnonzero(np.r_[True, (kmer[order][1:] != kmer[order][:-1]) | (content[order][1:] != content[order][:-1])])
                        times[order[head]] = np.diff(np.r_[head, len(order)])
                    columns = [kmer, content, docs_[text], rows[text], start, count.astype(np.int32), ahead.astype(np.int32), times]
                    yield _arrow("kmer content doc row start windows ahead times", columns, {"windows": pa.int32(), "ahead": pa.int32(), "times": pa.int32()})
                done += len(part)

    return docs.select("doc", "row", "text").mapInArrow(run, "kmer long, content long, doc long, row long, start long, windows int, ahead int, times int")


def cut_stretches(docs: DataFrame, length: int) -> DataFrame:
    """docs (doc, row, text, asked) to the bytes of the asked stretches: (kmer, doc, row, start, ahead, counted, hot, bytes)."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            out: list[tuple] = []
            for doc, row, text, asked in zip(*(batch.column(k).to_pylist() for k in range(4)), strict=True):
                data = text.encode()
                out += [(a["kmer"], doc, row, a["start"], a["ahead"], a["counted"], a["hot"], data[a["start"] : a["start"] + a["windows"] - 1 + length]) for a in asked]
            if out:
                yield _arrow("kmer doc row start ahead counted hot bytes", list(zip(*out, strict=True)), {"ahead": pa.int32(), "counted": pa.bool_(), "hot": pa.bool_(), "bytes": pa.binary()})

    return docs.select("doc", "row", "text", "asked").mapInArrow(run, "kmer long, doc long, row long, start long, ahead int, counted boolean, hot boolean, bytes binary")


def common(a: bytes, b: bytes, known: int) -> int:
    """Length of the common prefix of a and b, of which known bytes are known."""
    n = min(len(a), len(b))
    while known + 16 <= n and a[known : known + 16] == b[known : known + 16]:
        known += 16
    while known < n and a[known] == b[known]:
        known += 1
    return known


def front_code(suffixes: list[bytes]) -> bytes:
    """A sorted run: for each suffix two bytes each for its common prefix with the one before and for what follows, then that."""
    out, last = [], b""
    for s in suffixes:
        h = common(last, s, 0)
        out.append(h.to_bytes(2, "little") + (len(s) - h).to_bytes(2, "little") + s[h:])
        last = s
    return b"".join(out)


def front_decode(run: bytes) -> Iterator[tuple[int, bytes]]:
    """(common prefix with the one before, suffix), one at a time."""
    at, last = 0, b""
    while at < len(run):
        h, n = int.from_bytes(run[at : at + 2], "little"), int.from_bytes(run[at + 2 : at + 4], "little")
        last = last[:h] + run[at + 4 : at + 4 + n]
        at += 4 + n
        yield h, last


def merge_runs(runs: list[Iterator[tuple[int, bytes]]]) -> Iterator[tuple[int, int, bytes]]:
    """(run, common prefix with the suffix before, suffix) in order of all runs, by a loser tree.

    Each contender carries its common prefix with the last winner. The longer one wins unseen; only equal ones are
    compared, from there on, and the loser then carries what it has in common with the winner.
    """
    k = 1
    while k < len(runs):
        k *= 2
    runs = [*runs, *[iter(())] * (k - len(runs))]
    head: list[bytes | None] = [None] * k
    share = [0] * k
    for r, run in enumerate(runs):
        first = next(run, None)
        head[r] = first[1] if first else None

    def play(a: int, b: int) -> tuple[int, int]:
        """Winner and loser."""
        x, y = head[a], head[b]
        if x is None or y is None:
            return (b, a) if x is None else (a, b)
        if share[a] != share[b]:
            return (a, b) if share[a] > share[b] else (b, a)
        h = common(x, y, share[a])
        if x[h : h + 1] < y[h : h + 1] or (len(x) == len(y) == h and a < b):
            share[b] = h
            return a, b
        share[a] = h
        return b, a

    loser = [0] * k
    winners = list(range(k))
    level = k
    while level > 1:
        level //= 2
        nxt = []
        for i in range(level):
            w, loser[level + i] = play(winners[2 * i], winners[2 * i + 1])
            nxt.append(w)
        winners = nxt
    best = winners[0]
    while head[best] is not None:
        yield best, share[best], head[best]
        following = next(runs[best], None)
        share[best], head[best] = following if following else (0, None)
        node = (best + k) // 2
        while node >= 1:
            best, loser[node] = play(best, loser[node])
            node //= 2


def sorted_runs(cut: DataFrame, splitters: list[bytes], parts: int, kmer: int) -> DataFrame:
    """A front-coded run for each task and range: (range, suffixes, and beside them doc, row, start, ahead, counted and the bytes before the anchor)."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        items: list[tuple] = []

        def flush() -> pa.RecordBatch:
            items.sort(key=lambda x: x[0])
            by: dict[int, list[tuple]] = {}
            for x in items:
                by.setdefault(bisect.bisect_right(splitters, x[0][:kmer]) * parts + (zlib.crc32(x[0][:kmer]) % parts), []).append(x)
            items.clear()
            cols = [list(by), [front_code([x[0] for x in v]) for v in by.values()]]
            cols += [[[x[k] for x in v] for v in by.values()] for k in range(1, 7)]
            kinds = {"suffixes": pa.binary(), "doc": pa.list_(pa.int64()), "row": pa.list_(pa.int64()), "start": pa.list_(pa.int64()), "ahead": pa.list_(pa.int32()), "counted": pa.list_(pa.bool_()), "before": pa.list_(pa.binary())}
            return _arrow("range suffixes doc row start ahead counted before", cols, kinds)

        for batch in batches:
            for doc, row, start, ahead, counted, data in zip(*(batch.column(k).to_pylist() for k in range(6)), strict=True):
                items.append((data[ahead:], doc, row, start, ahead, counted, data[:ahead]))
            if len(items) >= RUN:
                yield flush()
        if items:
            yield flush()

    schema = "range long, suffixes binary, doc array<long>, row array<long>, start array<long>, ahead array<int>, counted array<boolean>, before array<binary>"
    return cut.select("doc", "row", "start", "ahead", "counted", "bytes").mapInArrow(run, schema)


def merge_ranges(runs: DataFrame, length: int, kmer: int) -> DataFrame:
    """(doc, row, start, windows) of repeated windows, from the merged runs of each range."""

    def spans(block: list[tuple]) -> Iterator[tuple[int, int, int, int]]:
        """block: (suffix, common prefix with the one before, with the one after, doc, row, start, ahead, counted, before)."""
        data = np.frombuffer(b"".join(x[8] + x[0] for x in block), np.uint8)
        size = np.array([len(x[8]) + len(x[0]) for x in block], np.int64)
        begin = np.cumsum(size) - size
        ahead = np.array([x[6] for x in block], np.int64)
        reach = np.array([max(x[1], x[2]) for x in block], np.int64)
        # A window that starts w bytes into its stretch needs length - (ahead - w) bytes of the suffix.
        last = np.minimum(size - length, reach - length + ahead)
        n = np.maximum(last + 1, 0)
        item = np.repeat(np.arange(len(block)), n)
        if not len(item):
            return
        w = np.arange(len(item)) - np.repeat(np.cumsum(n) - n, n)
        at = begin[item] + w
        key = mix(Prefix(data).hash(at, at + length) + (ahead[item] - w).astype(np.uint64))
        order = np.argsort(key, kind="stable")
        same = key[order][1:] == key[order][:-1]
        twice = np.zeros(len(key), bool)
        twice[order[1:][same]] = True
        twice[order[:-1][same]] = True
        on = np.flatnonzero(twice)
        if not len(on):
            return
        head = np.flatnonzero(np.r_[True, (on[1:] != on[:-1] + 1) | (item[on[1:]] != item[on[:-1]])])
        for i, k, count in zip(item[on[head]].tolist(), w[on[head]].tolist(), np.diff(np.r_[head, len(on)]).tolist(), strict=True):
            x = block[i]
            if not x[7]:  # stretches that occur twice are repeated anyway
                yield x[3], x[4], x[5] + k, count

    def merged(rows: list[dict]) -> Iterator[tuple[int, int, int, int]]:
        at = [0] * len(rows)
        block: list[tuple] = []
        for r, share, suffix in merge_runs([front_decode(x["suffixes"]) for x in rows]):
            if share < kmer and len(block) >= 4_000:
                yield from spans(block)
                block = []
            if block:
                block[-1] = (*block[-1][:2], share, *block[-1][3:])
            x, k = rows[r], at[r]
            at[r] += 1
            block.append((suffix, share if block else 0, 0, x["doc"][k], x["row"][k], x["start"][k], x["ahead"][k], x["counted"][k], x["before"][k]))
        if block:
            yield from spans(block)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: list[dict] = []
        for batch in batches:
            for x in batch.to_pylist():
                if held and held[0]["range"] != x["range"]:
                    yield out(held)
                    held = []
                held.append(x)
        if held:
            yield out(held)

    def out(rows: list[dict]) -> pa.RecordBatch:
        found = list(zip(*merged(rows), strict=True)) or [()] * 4
        return _arrow("doc row start windows", found, {"windows": pa.int32()})

    tasks = int(runs.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    return runs.repartition(tasks, "range").sortWithinPartitions("range").mapInArrow(run, "doc long, row long, start long, windows int")


def hot_windows(cut: DataFrame, length: int) -> DataFrame:
    """(doc, row, start, windows 1) of repeated windows of hot anchors: windows as rows, counted with partial sums."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            raw = batch.column(5).to_pylist()
            if not raw:
                continue
            size = np.array([len(r) for r in raw], np.int64)
            data, begin, n = np.frombuffer(b"".join(raw), np.uint8), np.cumsum(size) - size, size - length + 1
            item = np.repeat(np.arange(len(raw)), n)
            w = np.arange(len(item)) - np.repeat(np.cumsum(n) - n, n)
            at = begin[item] + w
            ahead = batch.column(4).to_numpy().astype(np.int64)
            prefix = Prefix(data)
            key = mix(prefix.hash(at, at + length) + (ahead[item] - w).astype(np.uint64)).astype(np.int64)
            own = [batch.column(k).to_numpy(zero_copy_only=False)[item] for k in (0, 1, 2, 3, 6)]
            yield _arrow("kmer key doc row start counted", [own[0], key, own[1], own[2], own[3] + w, own[4]], {"counted": pa.bool_()})

    rows = cut.select("kmer", "doc", "row", "start", "ahead", "bytes", "counted").mapInArrow(run, "kmer long, key long, doc long, row long, start long, counted boolean")
    rows = stored(rows, "hot-windows")
    twice = stored(rows.groupBy("kmer", "key").agg(F.count("*").alias("n")).where("n > 1").drop("n"), "hot-keys")
    return rows.where("not counted").join(twice, ["kmer", "key"]).select("doc", "row", "start", F.lit(1).alias("windows"))


def repeated_spans(docs: DataFrame, length: int = LENGTH, kmer: int = KMER) -> DataFrame:
    """(doc, row, start, windows) for docs (doc, row, text): runs of windows that also start elsewhere."""
    spark, since = docs.sparkSession, tables_made()
    found = stored(find_stretches(docs, length), "stretches")
    known = found.where("times <> 1").select("doc", "row", "start", "windows")
    firsts = found.where("times > 0")
    often = stored(firsts.groupBy("kmer").agg(F.sum("times").alias("n")).where("n > 1").select("kmer"), "anchors")
    free_shuffles(spark)
    found = stored(firsts.join(often, "kmer"), "stretches-shared")
    free_shuffles(spark)
    kinds = found.groupBy("kmer", "content").agg(F.sum("times").alias("n"), F.first(F.struct("doc", "row", "start", "windows", "ahead")).alias("at"))
    kinds = stored(kinds.select("kmer", "content", (F.col("n") > 1).alias("counted"), "at.*"), "kinds")
    whole = found.where("times = 1").join(stored(kinds.where("counted").select("kmer", "content"), "whole-kinds"), ["kmer", "content"]).select("doc", "row", "start", "windows")
    whole = stored(whole.unionByName(known), "whole")
    needed = [last_made()]
    free_shuffles(spark)
    per_anchor = stored(kinds.groupBy("kmer").agg(F.count("*").alias("kinds")).where("kinds > 1"), "mixed-anchors")
    asked = kinds.join(per_anchor, "kmer").withColumn("hot", F.col("kinds") > HOT)
    asked = asked.groupBy("doc", "row").agg(F.collect_list(F.struct("kmer", "start", "windows", "ahead", "counted", "hot")).alias("asked"))
    cut = stored(cut_stretches(docs.join(asked, ["doc", "row"]), length), "cut")
    needed.append(last_made())
    drop_tables(spark, since, needed)
    free_shuffles(spark)
    cold = cut.where("not hot")
    n = cold.count()
    spans = [whole]
    if n:
        ranges = max(1, min(SPLITTERS, -(-n // RANGE)))
        prefix = F.substring(F.col("bytes"), F.col("ahead") + 1, F.lit(kmer))
        share = min(1.0, DRAWN * ranges / n * 4)
        drawn = sorted(bytes(r[0]) for r in cold.where(F.pmod(F.xxhash64("row", "start"), F.lit(1 << 20)) < int(share * (1 << 20)) + 1).select(prefix).collect()) if ranges > 1 else []
        splitters = sorted({drawn[len(drawn) * k // ranges] for k in range(1, ranges)}) if drawn else []
        runs = stored(sorted_runs(cold, splitters, -(-n // (ranges * RANGE)), kmer), "runs")
        spans.append(stored(merge_ranges(runs, length, kmer), "merged"))
        needed.append(last_made())
        drop_tables(spark, since, needed)
        free_shuffles(spark)
    hot = cut.where("hot")
    if not hot.isEmpty():
        spans.append(stored(hot_windows(hot, length), "hot"))
        free_shuffles(spark)
    out = spans[0]
    for s in spans[1:]:
        out = out.unionByName(s)
    return out


def covered(spans: list[tuple[int, int]], length: int) -> list[tuple[int, int]]:
    """Maximal runs of bytes that windows cover, for (start, windows)."""
    out: list[tuple[int, int]] = []
    for start, windows in sorted(spans):
        end = start + windows - 1 + length
        if out and start <= out[-1][1]:
            out[-1] = (out[-1][0], max(out[-1][1], end))
        else:
            out.append((start, end))
    return out


def remove_repeats(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", length: int = LENGTH, extra: list[str] | None = None) -> DataFrame:
    """(doc_id, n_bytes, n_removed, n_spans, kept_sha256, kept, and the columns named in extra); kept is the remaining bytes as text, without characters that lost a byte."""
    found = _removed(docs, id_col, text_col, length, extra or [])
    return found.withColumnsRenamed({f"x_{k}": c for k, c in enumerate(extra or [])})


def _removed(docs: DataFrame, id_col: str, text_col: str, length: int, extra: list[str]) -> DataFrame:
    """As `remove_repeats`, with the extra columns as x_0, x_1, and so on, whatever their names."""
    text = F.coalesce(F.col(text_col).cast("string"), F.lit(""))
    kept_cols = [F.col(c).alias(f"x_{k}") for k, c in enumerate(extra)]
    rows = docs.select(F.col(id_col).cast("long").alias("doc_id"), text.alias("text"), *kept_cols)
    # Rows that are equal in both are one row to all that follows; they have the same spans, which are gathered once.
    rows = rows.withColumns({"doc": F.coalesce("doc_id", F.lit(-1)), "row": F.xxhash64("text")})
    spans = repeated_spans(rows.select("doc", "row", "text"), length).distinct()
    per_row = spans.groupBy("doc", "row").agg(F.collect_list(F.struct("start", "windows")).alias("spans"))

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            size, removed, runs, sha, kept = [], [], [], [], []
            for text, spans in zip(batch.column("text").to_pylist(), batch.column("spans").to_pylist(), strict=True):
                data = text.encode()
                gone = covered([(s["start"], s["windows"]) for s in spans or []], length)
                left = b"".join(data[a:b] for a, b in zip([0, *(e for _, e in gone)], [*(s for s, _ in gone), len(data)], strict=True))
                size.append(len(data))
                removed.append(len(data) - len(left))
                runs.append(len(gone))
                sha.append(hashlib.sha256(left).hexdigest())
                kept.append(left.decode(errors="ignore"))
            others = [batch.column(f"x_{k}") for k in range(len(extra))]
            yield pa.RecordBatch.from_arrays([batch.column("doc_id"), pa.array(size, pa.int64()), pa.array(removed, pa.int64()), pa.array(runs, pa.int64()), pa.array(sha, pa.string()), pa.array(kept, pa.string()), *others], names)

    names = ["doc_id", "n_bytes", "n_removed", "n_spans", "kept_sha256", "kept", *(f"x_{k}" for k in range(len(extra)))]
    joined = rows.join(per_row, ["doc", "row"], "left").select("doc_id", "text", "spans", *(f"x_{k}" for k in range(len(extra))))
    types = {f.name: f.dataType.simpleString() for f in rows.schema}
    schema = "doc_id long, n_bytes long, n_removed long, n_spans long, kept_sha256 string, kept string" + "".join(f", x_{k} {types[f'x_{k}']}" for k in range(len(extra)))
    return joined.mapInArrow(cut, schema)


def thinned_documents(docs: DataFrame) -> DataFrame:
    """docs with repeated bytes removed from text, and n_chars of what is left; other columns stay."""
    others = [c for c in docs.columns if c not in ("doc_id", "text", "n_chars")]
    own = {"doc_id": F.col("doc_id"), "text": F.col("kept"), "n_chars": F.length("kept").cast("long")} | {c: F.col(f"x_{k}") for k, c in enumerate(others)}
    return _removed(docs, "doc_id", "text", LENGTH, others).select(*(own[c].alias(c) for c in docs.columns))


def op10_suffix_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return remove_repeats(table(spark, sf_dir, "documents")).drop("kept")
