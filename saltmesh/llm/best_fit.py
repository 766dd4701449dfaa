"""Best-fit packing with certified bin counts.

Documents become pieces of at most CAPACITY tokens (only longer documents are cut). Pieces are dealt over at least two
partitions of bounded size; each packs its pieces best-fit decreasing and computes a lower bound of its bin count from
dual feasible functions (sizes over half the capacity are rounded up, sizes below a threshold are dropped, and rounding
functions). A partition whose count meets its bound is certified and keeps its bins. A partition with a gap keeps its
full bins and gives the pieces of the bins with room to a pool; the pool is dealt anew, so that such partitions exchange
documents, and is packed again. When no partition has a gap, the bins with room of all partitions are pooled and packed
in the same way, as each may have one too many. The same bound over all pieces certifies the total: rounds end when the
total meets it, when the pool no longer shrinks, or after ROUNDS. Where the pool comes down to one partition that still
has a gap, it exchanges up to EXCHANGES times with full bins of the others. `certified` says whether the total met the bound.

Defined results: null or empty text has only the final id 0, a piece of length 1. Repeated rows are packed each on their
own; rows that are equal in every column are still dealt apart. Of pieces of equal size the one that comes first in its
partition is placed first. Texts of any length are cut whole; a word of any length is tokenised, but none over
KEPT_CHARS is kept. An empty table gives an empty result; extra columns of documents are ignored, those of pieces are
carried, and where one has the name of a column that `pack` adds, the added one takes its place.
"""

from __future__ import annotations

import json
import re
import zlib
from array import array
from collections import Counter
from collections.abc import Iterator
from itertools import filterfalse, pairwise

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .shared import keep_only, stored, table

CAPACITY = 2048
#: Pieces that one task packs at once.
PIECES_AT_ONCE = 20_000
ROUNDS, EXCHANGES = 6, 3
#: Bytes of text that a task cuts into words at once, and new words that go to the library at once.
TEXT_AT_ONCE, LEARNED_AT_ONCE = 1_000_000, 5_000
#: Distinct words in each of the two generations that a worker keeps (about 200 bytes each), and the longest one kept.
WORDS_KEPT, KEPT_CHARS = 150_000, 40

PIECES = "doc_id long, piece int, start long, length long, ids_crc32 long"

# What the tokenizer file has to say for words to be tokenised on their own, and plain words by their stems.
NORMALIZERS = [{"type": "NFC"}, {"type": "Replace", "pattern": {"Regex": "\\s+"}, "content": " "}, {"type": "Lowercase"}]
WORD_PATTERN = "'s|'t|'re|'ve|'m|'ll|'d|[\\p{L}]+|[\\p{N}]|[^\\s\\p{L}\\p{N}]+"
WORD_END = "</w>"

#: What makes a word between spaces other than plain: characters beyond ASCII and the letters of Latin-1, and the start of an added token.
_ODD = re.compile(r"[^\t\n\r -~À-ÖØ-öø-ÿ]|<\|")
#: Kinds of bytes in UTF-8. Of what is plain only the letters from À to ÿ have bytes from 128 on: 195 and another one.
SPACE, LETTER, DIGIT, SIGN, ODD = range(5)
_KIND = bytes(
    SPACE if b in b" \t\n\r" else DIGIT if chr(b) in "0123456789" else ODD if b < 32 or b in (127, 0x97, 0xB7) or b > 191 and b != 195 else LETTER if b > 127 or chr(b).isalpha() else SIGN
    for b in range(256)
)
_LOWER = bytes(b + 32 if 65 <= b <= 90 or 0x80 <= b <= 0x9E else b for b in range(256))


def cut_words(texts: pa.Array) -> tuple[pa.Array, np.ndarray]:
    """The words of the tokenizer in lower case, one after another, and before which of them each text begins, with their number at the end. What stands between spaces and is not plain is one word as it is."""
    texts = texts.cast(pa.large_string())
    at = np.frombuffer(texts.buffers()[1], np.int64)[texts.offset : texts.offset + len(texts) + 1]
    if not len(at) or at[0] == at[-1]:
        return pa.array([], pa.large_string()), np.zeros(len(texts) + 1, np.int64)
    raw = memoryview(texts.buffers()[2])[at[0] : at[-1]].tobytes()
    at = at - at[0]
    n = len(raw)
    kind, lower = np.frombuffer(bytearray(raw.translate(_KIND)), np.uint8), np.frombuffer(raw.translate(_LOWER), np.uint8)
    head = np.zeros(n + 1, bool)
    head[at] = True
    odd = np.flatnonzero(kind == ODD)
    if b"<|" in raw:
        odd = np.r_[odd, [k for k in (m.start() for m in re.finditer(rb"<\|", raw)) if not head[k + 1]]].astype(np.int64)
    if len(odd):
        part = np.cumsum((kind == SPACE) | head[:-1])
        is_odd = np.zeros(part[-1] + 1, bool)
        is_odd[part[odd]] = True
        whole = is_odd[part] & (kind != SPACE)
        kind[whole] = ODD
        lower = np.where(whole, np.frombuffer(raw, np.uint8), lower)
    begins = head[:-1] | (kind == DIGIT)
    begins[1:] |= kind[1:] != kind[:-1]
    # Contractions: a sign that is an apostrophe alone, with the letters right after it.
    a = np.flatnonzero(begins[:-1] & (lower[:-1] == ord("'")) & (kind[:-1] == SIGN) & (kind[1:] == LETTER) & ~head[1:-1])
    first, second = lower[a + 1], np.where(head[a + 2], 0, lower[np.minimum(a + 2, n - 1)])
    short = np.isin(first, list(b"stmd"))
    long = np.isin(first.astype(np.int64) << 8 | second, [x[0] << 8 | x[1] for x in (b"re", b"ve", b"ll")])
    begins[a[short | long] + 1] = False
    rest = np.r_[a[short] + 2, a[long] + 3]
    begins[rest[rest < n]] = True
    starts = np.flatnonzero(begins)
    lengths = np.diff(starts, append=n)
    solid = kind[starts] != SPACE
    starts, offsets = starts[solid], np.r_[0, np.cumsum(lengths[solid])]
    words = pa.LargeStringArray.from_buffers(len(starts), pa.py_buffer(offsets), pa.py_buffer(lower[kind != SPACE]))
    return words, np.searchsorted(starts, at)


#: The characters under which the model lists bytes: those of Latin-1 that can be seen as they are, the others from 256 on. The space stays, to part words.
_HIDDEN = [b for b in range(256) if not (33 <= b <= 126 or 161 <= b <= 172 or b >= 174)]
_SHOWN = np.arange(256, dtype="<u4")
_SHOWN[_HIDDEN] = 256 + np.arange(len(_HIDDEN))
_SHOWN[32] = 32


class WordTokenizer:
    """Token ids of texts. Each word between spaces is tokenised once, as no token reaches across white space."""

    def __init__(self, path: str):
        from tokenizers import Tokenizer, pre_tokenizers

        self.tokenizer = Tokenizer.from_file(path)
        with open(path, encoding="utf-8") as f:
            given = json.load(f)
        vocab = given["model"]["vocab"]
        split = (given["pre_tokenizer"] or {}).get("pretokenizers", [{}])[0]
        self.by_word = (given["normalizer"] or {}).get("normalizers") == NORMALIZERS and split.get("pattern") == {"Regex": WORD_PATTERN}
        self.by_word &= given["model"].get("end_of_word_suffix") == WORD_END and not any(" " in t["content"] or t["lstrip"] or t["rstrip"] for t in given["added_tokens"])
        self.by_word &= all(chr(c) + end in vocab for b, c in enumerate(_SHOWN) if b != 32 for end in ("", WORD_END))
        #: The model's own merges, past the steps that only cut texts into words, and the tokens that end a word.
        self.merges = Tokenizer(self.tokenizer.model)
        self.merges.pre_tokenizer = pre_tokenizers.WhitespaceSplit()
        self.last = np.zeros(1 + max(vocab.values()), bool)
        self.last[[i for t, i in vocab.items() if t.endswith(WORD_END)]] = True
        self.young: dict[str, bytes] = {}
        self.old: dict[str, bytes] = {}

    def learn(self, words: list[str]) -> dict[str, bytes]:
        """Ids of plain words of the tokenizer, all in one call."""
        if not words:
            return {}
        shown = _SHOWN[np.frombuffer(" ".join(words).encode(), np.uint8)].tobytes().decode("utf-32-le")
        ids = np.array(self.merges.encode_batch_fast([shown], add_special_tokens=False)[0].ids, "<u4")
        ends = np.flatnonzero(self.last[ids]) + 1  # one in each word at least
        if len(words) == 1:
            return {words[0]: ids.tobytes()}
        if len(ends) > len(words):  # a word spells out the mark of the end
            half = len(words) // 2
            return self.learn(words[:half]) | self.learn(words[half:])
        data = ids.tobytes()
        return {w: data[k:end] for w, (k, end) in zip(words, pairwise([0, *(4 * ends).tolist()]), strict=True)}

    def look_up(self, words: list[str]) -> list[bytes]:
        """Ids of distinct words."""
        young, old = self.young, self.old
        new: dict[str, bytes] = {}
        plain: list[str] = []
        for w in filterfalse(young.__contains__, words):
            if w in old:
                new[w] = old[w]
            elif _ODD.search(w):
                new[w] = array("I", self.tokenizer.encode(w, add_special_tokens=False).ids).tobytes()
            else:
                plain.append(w)
        for k in range(0, len(plain), LEARNED_AT_ONCE):
            new |= self.learn(plain[k : k + LEARNED_AT_ONCE])
        young.update(new)
        ids = list(map(young.__getitem__, words))
        for w in [w for w in new if len(w) > KEPT_CHARS]:
            del young[w]
        if len(young) > WORDS_KEPT:
            self.old, self.young = young, {}
        return ids

    def ids(self, texts: list[str] | pa.Array) -> Iterator[bytes]:
        """For each text its ids as little-endian unsigned 32-bit numbers."""
        if not self.by_word:
            for e in self.tokenizer.encode_batch_fast(texts.to_pylist() if isinstance(texts, pa.Array) else texts, add_special_tokens=False):
                yield array("I", e.ids).tobytes()
            return
        words, begins = cut_words(pa.array(texts, pa.large_string()) if isinstance(texts, list) else texts)
        words = words.dictionary_encode()
        ids = pa.array(self.look_up(words.dictionary.to_numpy(zero_copy_only=False).tolist()), pa.large_binary()).take(words.indices)
        ends = np.r_[0, np.cumsum(pc.binary_length(ids).to_numpy())][begins].tolist()
        data = memoryview(ids.buffers()[2] or b"")
        for k, end in pairwise(ends):
            yield data[k:end].tobytes()


def text_slices(texts: pa.Array, size: int) -> Iterator[pa.Array]:
    """The texts in order (null: empty), in slices of about so many bytes, so that memory follows the slice and not the Arrow batch."""
    texts = pc.fill_null(texts, "")
    passed = np.cumsum(pc.binary_length(texts).to_numpy().astype(np.int64) + 100) // size
    at = np.flatnonzero(np.diff(passed, prepend=0, append=-1))
    for k, end in pairwise([0, *(at + 1).tolist()] if len(texts) else [0]):
        yield texts[k:end]


_tokenizers: dict[str, WordTokenizer] = {}


def tokenizer(path: str) -> WordTokenizer:
    """One for each Python worker."""
    keep_only(_tokenizers)
    if path not in _tokenizers:
        import os

        os.environ.setdefault("TOKENIZERS_PARALLELISM", "false")
        _tokenizers[path] = WordTokenizer(path)
    return _tokenizers[path]


def token_pieces(docs: DataFrame, path: str, capacity: int = CAPACITY, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Rows of PIECES: each document's ids, then id 0, cut into pieces of capacity tokens."""

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        words = tokenizer(path)
        for batch in batches:
            ids_of = (b for part in text_slices(batch.column(1), TEXT_AT_ONCE) for b in words.ids(part))
            out: list[tuple] = []
            for doc, ids in zip(batch.column(0).to_pylist(), ids_of, strict=True):
                ids += b"\0\0\0\0"
                for p, k in enumerate(range(0, len(ids), 4 * capacity)):
                    part = ids[k : k + 4 * capacity]
                    out.append((doc, p, k // 4, len(part) // 4, zlib.crc32(part)))
            cols = list(zip(*out, strict=True)) or [()] * 5
            kinds = [pa.int64(), pa.int32(), pa.int64(), pa.int64(), pa.int64()]
            yield pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(cols, kinds, strict=True)], [f.split()[0] for f in PIECES.split(", ")])

    return docs.select(F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).cast("string").alias("text")).mapInArrow(cut, PIECES)


def best_fit_decreasing(sizes: np.ndarray, capacity: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Bin and offset of each size, and the load of each bin. Bins are kept by the room left in them."""
    bins, offsets = np.zeros(len(sizes), np.int64), np.zeros(len(sizes), np.int64)
    loads: list[int] = []
    by_room: list[list[int]] = [[] for _ in range(capacity + 1)]
    rooms = 0  # bit r is set if a bin with room r is there
    for i in np.argsort(-sizes, kind="stable").tolist():
        size = int(sizes[i])
        fit = rooms >> size
        if fit:
            room = size + (fit & -fit).bit_length() - 1
            b = by_room[room].pop()
            if not by_room[room]:
                rooms ^= 1 << room
        else:
            room, b = capacity, len(loads)
            loads.append(0)
        bins[i], offsets[i] = b, loads[b]
        loads[b] += size
        if left := room - size:
            by_room[left].append(b)
            rooms |= 1 << left
    return bins, offsets, np.array(loads, np.int64)


def lower_bound(sizes: np.ndarray, capacity: int, counts: np.ndarray | None = None) -> int:
    """Bins that any packing needs: the best bound of two families of dual feasible functions over the size histogram (sizes, each counts times)."""
    if not len(sizes):
        return 0
    size, n = np.unique(sizes, return_counts=True) if counts is None else (sizes, counts)
    best = -(-int((size * n).sum()) // capacity)
    # Family 1: sizes over capacity - k count as full bins, sizes under k as nothing.
    for k in {0, *size[2 * size <= capacity].tolist()}:
        value = np.where(size > capacity - k, capacity, np.where(size < k, 0, size))
        best = max(best, -(-int((value * n).sum()) // capacity))
    # Family 2: f(x) = x if (m + 1) x / capacity is whole, else floor((m + 1) x / capacity) * capacity / m.
    for m in range(1, 21):
        whole = (m + 1) * size % capacity == 0
        value = np.where(whole, size * m, (m + 1) * size // capacity * capacity)
        best = max(best, -(-int((value * n).sum()) // (capacity * m)))
    return best


def _union(parts: list[DataFrame]) -> DataFrame:
    out = parts[0]
    for p in parts[1:]:
        out = out.unionByName(p)
    return out


ADDED = ("sequence_id", "offset", "certified")


def pack(pieces: DataFrame, capacity: int = CAPACITY, rounds: int = ROUNDS, at_once: int = PIECES_AT_ONCE) -> DataFrame:
    """pieces (any columns, with length from 1 to capacity) with sequence_id, offset and certified (the bins of all pieces are as few as their bound)."""
    carried = [c for c in pieces.columns if c not in ADDED]
    # Own names inside, so that no carried column can clash.
    table = stored(pieces.select(F.col("length").cast("long").alias("size"), *(F.col(f"`{c}`").alias(f"x_{k}") for k, c in enumerate(carried))), "unpacked")
    fields = table.columns
    schema = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in table.schema) + ", bin long, place long, full boolean, tight boolean"
    histogram = sorted((r["size"], r["count"]) for r in table.groupBy("size").count().collect())  # at most capacity rows
    bound = lower_bound(np.array([s for s, _ in histogram], np.int64), capacity, np.array([c for _, c in histogram], np.int64))

    def pack_one(turn: int):
        def run(key: tuple, part: pa.Table) -> pa.Table:
            sizes = part["size"].to_numpy()
            bins, offsets, loads = best_fit_decreasing(sizes, capacity)
            tight = len(loads) == lower_bound(sizes, capacity)
            found = [(turn << 56) + (key[0].as_py() << 28) + bins, offsets, loads[bins] == capacity, np.full(len(sizes), tight)]
            return pa.table([*part.select(fields).columns, *map(pa.array, found)], [*fields, "bin", "place", "full", "tight"])

        return run

    def packed_in(pool: DataFrame, parts: int, turn: int) -> tuple[DataFrame, dict]:
        """The pool packed in so many partitions, and its bins and pieces by (full, tight)."""
        # Stored rows are numbered alike whenever they are read again; another seed in each round lets partitions exchange pieces.
        dealt = pool.select(*fields).withColumn("deal", F.pmod(F.xxhash64(F.lit(turn), F.monotonically_increasing_id()), F.lit(parts)))
        packed = stored(dealt.groupBy("deal").applyInArrow(pack_one(turn), schema), f"packed-{turn}")
        groups = packed.groupBy("full", "tight").agg(F.count(F.when(F.col("place") == 0, 1)).alias("bins"), F.count("*").alias("n"))
        return packed, Counter({(r["full"], r["tight"], of): r[of] for r in groups.collect() for of in ("bins", "n")})

    def bins_of(seen: dict, full: tuple = (True, False)) -> int:
        return sum(v for (f, _, of), v in seen.items() if of == "bins" and f in full)

    pool, n, total = table, sum(c for _, c in histogram), sum(c for _, c in histogram)
    done: list[DataFrame] = []
    waiting: list[DataFrame] = []  # bins with room of certified partitions
    n_done = n_waiting = 0
    pooled = None
    for turn in range(rounds):
        parts = max(1 if turn else 2, -(-n // at_once))
        packed, seen = packed_in(pool, parts, turn)
        bins = n_done + n_waiting + bins_of(seen)
        gap = seen[False, False, "n"]
        rest = gap + seen[False, True, "n"]
        if bins == bound or (parts == 1 and not waiting):
            break
        n_done += bins_of(seen, (True,))
        done.append(packed.where("full"))
        if gap and parts > 1 and gap < 0.9 * n:
            waiting.append(packed.where("not full and tight"))
            n_waiting += seen[False, True, "bins"]
            pool, n = packed.where("not full and not tight"), gap
        else:
            open_bins = _union([*waiting, packed.where("not full")])
            n = open_bins.count() if waiting else rest
            pool, waiting, n_waiting = open_bins, [], 0
            if turn == rounds - 1 or (pooled is not None and n > 0.9 * pooled):
                packed = pool
                break
            pooled = n
    else:
        packed = pool
    if bins != bound and parts == 1 and not waiting:
        # The last partition has a gap: it exchanges with full bins of the others, as many as it can hold.
        for again in range(rounds, rounds + EXCHANGES):
            chosen = F.pmod(F.xxhash64("bin", F.lit(again)), F.lit(max(1, -(-total // at_once)))) == 0
            mixed = _union([packed, *(d.where(chosen) for d in done)])
            tried, seen = packed_in(mixed, 1, again)
            fewer = mixed.where("place = 0").count() - bins_of(seen)
            if fewer > 0:
                done, packed, bins = [d.where(~chosen) for d in done], tried, bins - fewer
            if bins == bound:
                break
    certified = bins == bound
    out = _union([*done, *waiting, packed])
    names = [F.col(f"x_{k}").alias(c) for k, c in enumerate(carried)]
    return out.select(*names, F.col("bin").alias("sequence_id"), F.col("place").alias("offset"), F.lit(certified).alias("certified"))


def pack_documents(docs: DataFrame, path: str, capacity: int = CAPACITY) -> DataFrame:
    return pack(token_pieces(docs, path, capacity), capacity)


def op6_best_fit(spark: SparkSession, sf_dir: str) -> DataFrame:
    return pack_documents(table(spark, sf_dir, "documents"), public_tokenizers.path("word_bpe_49k.json"))
