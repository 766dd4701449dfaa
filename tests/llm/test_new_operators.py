"""Fill-in-the-middle, decontamination and vector codes against plain restatements."""

import hashlib
import random
import re

import numpy as np
import pytest
from pyspark.sql import functions as F
from test_operators import DOCUMENTS, clashing, corpus, words

from saltmesh.llm import decontaminate, fill_middle, license_scan, vector_codes


@pytest.fixture(scope="module")
def rows():
    extra = ["a\nb\n\nc", "\n", "\r\nx y\x85z\n", "no <P> here", "<S", "a<\nS>\nb", "é\n漢😀\nq" * 50, "<S\n<M\n<P\n>" * 20]
    return corpus() + [(500 + k, t, "en", "s0", len(t)) for k, t in enumerate(extra)]


@pytest.fixture(scope="module")
def docs(spark, rows):
    return clashing(spark.createDataFrame(rows, DOCUMENTS)).repartition(3)


@pytest.fixture(scope="module")
def none(spark):
    return clashing(spark.createDataFrame([], DOCUMENTS))


def sha(text):
    return hashlib.sha256(text.encode()).hexdigest()


def plain_middle(doc_id, text, rate=100, suffix_first=50):
    text = text or ""
    lines = re.findall(r"[^\n]*\n|[^\n]+", text)
    n, digest = len(lines), sha(f"7:{'' if doc_id is None else doc_id}")
    h = [int(digest[8 * k : 8 * k + 8], 16) for k in range(4)]
    if not text or any(m in text for m in ("<P>", "<S>", "<M>")) or h[2] % 100 >= rate:
        return n, "plain", None, None, text
    a, b = sorted((h[0] % (n + 1), h[1] % (n + 1)))
    prefix, middle, suffix = "".join(lines[:a]), "".join(lines[a:b]), "".join(lines[b:])
    if h[3] % 100 < suffix_first:
        return n, "spm", len(prefix), len(middle), f"<S>{suffix}<P>{prefix}<M>{middle}"
    return n, "psm", len(prefix), len(middle), f"<P>{prefix}<S>{suffix}<M>{middle}"


@pytest.mark.parametrize("rate,suffix_first", [(100, 50), (40, 100), (0, 0)])
def test_fill_middle(docs, none, rows, rate, suffix_first):
    columns = ["doc_id", "n", "form", "prefix_chars", "middle_chars", "output", "output_sha256", "pieces"]
    found = fill_middle.arrange(docs, rate=rate, suffix_first=suffix_first)
    got = fill_middle.restore(found, keep=columns).collect()
    want = [(r[0], *plain_middle(r[0], r[1], rate, suffix_first), r[1] or "") for r in rows]
    assert sorted(repr((r["doc_id"], r["n"], r["form"], r["prefix_chars"], r["middle_chars"], r["output"], r["text"])) for r in got) == sorted(map(repr, want))
    marks = "<P><S><M>".encode()
    for r in got:
        assert (r["output_sha256"], r["restored_sha256"]) == (sha(r["output"]), sha(r["text"]))
        buffers = (r["text"].encode(), marks)
        assert b"".join(buffers[p["buffer"]][p["start"] : p["start"] + p["length"]] for p in r["pieces"]).decode() == r["output"]
    assert fill_middle.restore(fill_middle.arrange(none)).count() == 0


def test_piece_table():
    table = fill_middle.PieceTable("añb".encode(), b"xyz")
    table.cut([0, 0, 3, 4])
    assert [p[1:] for p in table.pieces] == [(0, 0), (0, 0), (0, 3), (3, 1), (4, 0)]
    table.add_marks([1, 2])
    order = [5, 3, 6, 2, 0, 1, 4]
    table.permute(order)
    assert table.content() == b"xbyz" + "añ".encode() and table.sha256() == hashlib.sha256(table.content()).hexdigest()
    table.permute(fill_middle.inverse(order))
    assert table.content() == "añb".encode() + b"xyz"
    with pytest.raises(ValueError):
        fill_middle.rebuilt(b"<P>a<S>b", "psm", [b"<P>", b"<S>", b"<M>"])


def plain_words(text):
    low = "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in text or "")
    return re.findall(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+", low)


def plain_scan(text, items, window=10):
    w, hit, met = plain_words(text), set(), set()
    for item, own in items:
        own = plain_words(own)
        n = min(len(own), window)
        grams = {tuple(own[k : k + n]) for k in range(len(own) - n + 1)} if n else set()
        at = [k for k in range(len(w) - n + 1) if tuple(w[k : k + n]) in grams] if n else []
        hit |= {k + j for k in at for j in range(n)}
        met |= {str(item)} if at and item is not None else set()
    return len(w), len(hit), len(met), sha(",".join(sorted(met))), bool(hit)


def items_of(rows):
    """Test items: passages of the corpus and others, short ones, repeated ones, one without an id or words."""
    rng = random.Random(8)
    long = [r[1] for r in rows if r[1] and len(r[1].split()) > 40][:8]
    cut = [" ".join(t.upper().split()[5:30]) for t in long]
    return [*enumerate(cut), (0, cut[0]), (70, cut[1]), (71, cut[1] + " more words"), (80, "a b c d"), (81, "12, 34"), (82, "x"), (83, "--"), (84, None), (None, cut[3] + " z"), (90, words(rng, 40)), (9, cut[2])]


@pytest.mark.parametrize("broadcast_bytes", [64 << 20, 3000])
def test_decontaminate(spark, docs, none, rows, broadcast_bytes, monkeypatch):
    monkeypatch.setattr(decontaminate.contaminated_texts, "__defaults__", (*decontaminate.contaminated_texts.__defaults__[:-1], broadcast_bytes))
    items = items_of(rows)
    benchmark = clashing(spark.createDataFrame(items, "item_id long, text string"))
    got = [tuple(r) for r in decontaminate.scan(docs, benchmark).collect()]
    want = [(r[0], *plain_scan(r[1], items)) for r in rows]
    assert sorted(map(repr, got)) == sorted(map(repr, want)) and 5 < sum(r[-1] for r in want) < len(want)
    if broadcast_bytes > 3000:
        assert decontaminate.scan(none, benchmark).count() == 0
        bare = decontaminate.scan(docs, benchmark.limit(0)).collect()
        assert len(bare) == len(rows) and not any(r["contaminated"] for r in bare)


def test_decontaminate_by_shuffle(docs, rows, spark, monkeypatch):
    monkeypatch.setattr(decontaminate, "BROADCAST_ROWS", 0)
    items = items_of(rows)
    got = decontaminate.scan(docs, spark.createDataFrame(items, "item_id long, text string")).collect()
    assert sorted(repr(tuple(r)) for r in got) == sorted(repr((r[0], *plain_scan(r[1], items))) for r in rows)


def test_cleaned_documents(spark, docs, rows):
    items = items_of(rows)
    benchmark = spark.createDataFrame(items, "item_id long, text string")
    kept = decontaminate.cleaned_documents(docs, benchmark, "documents")
    assert kept.columns == docs.columns
    clean = sorted(repr(r[:2]) for r in rows if not plain_scan(r[1], items)[-1])
    assert sorted(repr((r["doc_id"], r["text"])) for r in kept.collect()) == clean
    spans = decontaminate.cleaned_documents(docs, benchmark, "spans")
    assert spans.columns == docs.columns and spans.count() == len(rows)
    texts = {repr(r[:2]) for r in rows}
    for r in spans.collect():
        if repr((r["doc_id"], r["text"])) not in texts:
            old = next(x for x in rows if x[0] == r["doc_id"])
            n, hit, *_ = plain_scan(old[1], items)
            assert len(plain_words(r["text"])) == n - hit
    one = spark.createDataFrame([(1, " -- Keep This, one two three four five six seven eight nine TEN; and that.\n")], "doc_id long, text string")
    test = spark.createDataFrame([(1, "one two three four five six seven eight nine ten")], "item_id long, text string")
    assert decontaminate.cleaned_documents(one, test).collect()[0]["text"] == " -- Keep This, and that.\n"
    with pytest.raises(ValueError):
        decontaminate.cleaned_documents(one, test, "words")


def plain_codes(vectors, parts=4, entries=256, rounds=4):
    """vectors: whole numbers in order of their ids; loops over entries, no cells."""
    wide = vectors.shape[1] // parts
    out, error, books = [], np.zeros(len(vectors), np.int64), []
    for p in range(parts):
        x = vectors[:, p * wide : (p + 1) * wide]
        book = x[:entries].copy()
        near = lambda: ((x[:, None, :] - book[None]) ** 2).sum(2)  # noqa: B023, E731
        for _ in range(rounds):
            best = near().argmin(1)
            for e in range(len(book)):
                own = x[best == e]
                if len(own):
                    book[e] = np.floor_divide(own.sum(0), len(own))
        d = near()
        out.append(d.argmin(1))
        error += d.min(1)
        books.append(book)
    return ["".join(f"{c:02x}" for c in r) for r in np.stack(out, 1)], error, np.stack(books)


@pytest.mark.parametrize("kind", ["noise", "clusters", "ties", "few"])
def test_vector_codes(spark, kind):
    rng = np.random.default_rng(4)
    n = 40 if kind == "few" else 700
    x = {"noise": rng.normal(0, 0.2, (n, 16)), "few": rng.normal(0, 0.2, (n, 16)), "clusters": rng.integers(0, 9, (n, 16)) / 4 + rng.normal(0, 0.005, (n, 16)), "ties": rng.integers(-2, 3, (n, 16)) / 1024.0}[kind].astype(np.float32)
    data = [(k, v.tolist(), [1, 2, None][k % 3]) for k, v in enumerate(x)]
    odd = [(n + 1, None, 1), (n + 2, [0.1] * 15 + [None], 1), (n + 3, [0.1] * 15 + [float("nan")], 1), (n + 4, [float("inf")] + [0.0] * 15, 1), (n + 5, [], 1), (n + 6, [0.5] * 8, 1), (n + 7, [0.5] * 18, 1)]
    df = clashing(spark.createDataFrame(rng.permutation(np.array(data + odd, object)).tolist(), "vec_id long, embedding array<float>, label int")).repartition(3)
    table, width = vector_codes.usable(df, "vec_id", "embedding", "label")
    assert width == 16
    books = vector_codes.fit_codebooks(table, width)
    codes = vector_codes.encode(table, books)
    got = {r["id"]: r for r in vector_codes.with_label_error(codes).collect()}
    code, error, plain = plain_codes(np.floor(x.astype(float) * 1024).astype(np.int64))
    assert (books == plain).all() and sorted(got) == list(range(n))
    of_label = [int(error[k::3].sum()) for k in range(3)]
    assert [(got[k]["code"], got[k]["error"], got[k]["label_error"]) for k in range(n)] == [(code[k], int(error[k]), of_label[k % 3]) for k in range(n)]
    for r in vector_codes.decode(codes, books).limit(20).collect():
        away = np.floor(x[r["id"]].astype(float) * 1024) - np.array(r["vector"]) * 1024
        assert int((away**2).sum()) == r["error"]


def test_vector_codes_of_odd_tables(spark, tmp_path):
    empty = spark.createDataFrame([], "vec_id long, embedding array<float>, label int")
    empty.write.parquet(f"{tmp_path}/a/embeddings.parquet")
    assert vector_codes.op13_vector_codes(spark, f"{tmp_path}/a").count() == 0
    same = [(k % 3 or None, [0.25] * 8, k % 2) for k in range(30)]
    spark.createDataFrame(same, empty.schema).write.parquet(f"{tmp_path}/b/embeddings.parquet")
    got = vector_codes.op13_vector_codes(spark, f"{tmp_path}/b").collect()
    assert len(got) == 30 and {(r["code"], r["error"], r["label_error"]) for r in got} == {("00000000", 0, 0)}
    spark.createDataFrame([(1, [1e30] * 4, 0)], empty.schema).write.parquet(f"{tmp_path}/c/embeddings.parquet")
    with pytest.raises(Exception, match="beyond"):
        vector_codes.op13_vector_codes(spark, f"{tmp_path}/c")


def test_cells_compare_few_entries():
    """On clustered parts most cells are known and hold few entries; the answer is that of all entries, ties included."""
    rng = np.random.default_rng(6)
    centres = rng.integers(-500, 500, (256, 16))
    cache = vector_codes.CellCache(centres)
    for _ in range(4):
        x = centres[rng.integers(256, size=3000)] + rng.integers(-1, 2, (3000, 16)) * (rng.random((3000, 16)) < 0.05)
        best, error = cache.nearest(x)
        d = ((x[:, None, :] - centres[None]) ** 2).sum(2)
        assert (best == d.argmin(1)).all() and (error == d.min(1)).all()
    assert cache.made < 0.5 * cache.asked and cache.compared < 4 * cache.asked
    small = vector_codes.CellCache(centres, kept=10)
    assert (small.nearest(x)[0] == best).all() and len(small.cells) <= 10


def test_license_postings_meet_by_relative_position():
    """Every template word has postings; places begin with a head word alone, and all that weigh enough are found, whatever a file holds besides."""
    rng = random.Random(12)
    vocab = sorted(license_scan.vocabulary())
    index = license_scan.RareTokenIndex({b"": 1000, **{w: rng.choice([0, 1, 5, 60, 900]) for w in vocab}})
    assert sum(map(len, index.postings.values())) == sum(len(words) for _, words, _, _ in index.templates)
    for t, (_, words, _, _) in enumerate(index.templates):
        assert index.head[t] and sum(index.idf[w] for w in words if w not in index.head[t]) < index.need[t]
    for _ in range(60):
        text = []
        for _ in range(rng.randint(1, 6)):
            own = rng.choice(index.templates)[1]
            text += [w if rng.random() < 0.85 else rng.choice(vocab) for w in own] + [rng.choice([*vocab, b"word"]) for _ in range(rng.randint(0, 30))]
        want = {
            (t, start)
            for t, (_, words, _, _) in enumerate(index.templates)
            for start in range(-len(words), len(text))
            if sum(index.idf[w] for i, w in enumerate(words, start) if 0 <= i < len(text) and text[i] == w) >= index.need[t]
        }
        assert set(index.intersected(text)) == want
