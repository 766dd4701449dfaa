"""Each operator on nulls, empty and long texts, ties, repeated rows, empty tables and clashing columns, against plain restatements."""

import hashlib
import math
import random
import re
import zlib
from collections import Counter

import numpy as np
import pytest
from pyspark.sql import functions as F

from saltmesh.llm import best_fit, language_crf, license_scan, media_columns, multi_index, ngram_join, piece_bpe, quality_bayes, queries, suffix_dedup, warc

DOCUMENTS = "doc_id long, text string, lang string, source string, n_chars long"
# Names that operators use inside.
CLASHING_NAMES = ("row", "block", "key", "rep", "p", "score", "digest", "payload", "spans", "x_0", "host", "path", "keep", "labels", "component", "tokens", "_id", "_n", "id", "html", "kept", "n_bytes", "n_removed", "n_spans", "kept_sha256", "runs", "n_hit", "w", "at", "draws", "output", "v")


def clashing(df):
    return df.withColumns({c: F.lit(7) for c in CLASHING_NAMES if c not in df.columns})


def words(rng, n, stock=None):
    stock = stock or ["tha", "ring", "on", "der", "und", "zu", "le", "que", "casa", "mar", "océan", "über", "w", "tide"]
    return " ".join(rng.choice(stock) + rng.choice(["", "s", "er", "ion"]) for _ in range(n))


def corpus():
    """Rows with everything that must not break an operator."""
    rng = random.Random(3)
    base = [words(rng, rng.randint(1, 120)) for _ in range(40)]
    long = words(rng, 6000)
    texts = [None, "", " ", "\n\n", "x", "a b c d", "12 34 !!", "é漢😀▁ ́", *base, *base[:12], base[3], base[3], long, long[:-3], "ab" * 3000]
    passage = words(rng, 60)
    texts += [words(rng, 30) + " " + passage + " " + words(rng, 30) for _ in range(5)]
    near = base[0] + " " + words(rng, 150)
    texts += [near, near.replace("tha", "thb", 2), near + " end"]
    texts += ["Licensed under CC BY-NC 4.0. All rights reserved, cc by", "all rights reserved all rights reserved", "This is under the GNU General Public License, version 3", "cc  by\ngeneral public"]
    rows = [(k, t, ["en", "de", None][k % 3], ["s0", "s0", "s1", None][k % 4], None if t is None else len(t)) for k, t in enumerate(texts)]
    return rows + [rows[12], rows[0], rows[1], (None, "no id here at all", "en", "s0", 17)]


@pytest.fixture(scope="module")
def rows():
    return corpus()


@pytest.fixture(scope="module")
def docs(spark, rows):
    return clashing(spark.createDataFrame(rows, DOCUMENTS)).repartition(3)


@pytest.fixture(scope="module")
def none(spark):
    return clashing(spark.createDataFrame([], DOCUMENTS))


def by_row(found, rows, *columns):
    """Sorted (doc_id, columns) of a result, as comparable text."""
    got = sorted(repr((r["doc_id"], *(r[c] for c in columns))) for r in found.collect())
    assert len(got) == len(rows)
    return got


def test_license_scan(docs, none, rows):
    def plain(text):
        low = "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in text or "")
        w = re.findall(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+", low)
        at, labels = [], set()
        for phrase, label in license_scan.BASE.items():
            p = phrase.split()
            hit = [k for k in range(len(w)) if w[k : k + len(p)] == p]
            at += hit
            labels |= {label} if hit else set()
        return len(w), len(at), min(at, default=None), max(at, default=None), ",".join(sorted(labels))

    found = license_scan.scan_licenses(docs)
    want = sorted(repr((r[0], *plain(r[1]))) for r in rows)
    assert by_row(found, rows, "n_words", "n_base", "first_word", "last_word", "base_labels") == want
    got = {r["doc_id"]: r for r in found.collect()}
    labelled = [r for r in got.values() if "cc-by-nc-4.0" in r["labels"]]
    assert len(labelled) == 1 and "reserved" in labelled[0]["labels"] and 0 <= labelled[0]["score"] <= 1
    assert license_scan.scan_licenses(none).count() == 0


def test_license_scan_of_several_licences(spark):
    """A file with many rare licence words keeps every label: the shares are those of all template words."""
    texts = {label: template for label, template, _ in license_scan.TEMPLATES}
    joined = ". ".join(texts[x] for x in ("bsd", "apache-2.0", "mit"))
    everything = " -- ".join([*texts.values(), *license_scan.BASE])
    common = ["licensed under the license version 2 0 apache mit released"] * 60 + ["plain words"] * 200
    docs = spark.createDataFrame(list(enumerate([joined, everything, "apache license version 2 of use", *common])), "doc_id long, text string")
    got = {r["doc_id"]: r for r in license_scan.scan_licenses(docs).collect()}
    assert got[0]["labels"] == "apache-2.0,bsd,mit" and got[0]["score"] == 1.0
    assert got[1]["labels"] == ",".join(sorted([*texts, *license_scan.BASE.values()]))

    index = license_scan.RareTokenIndex(license_scan.document_frequency(docs))
    for label, template, _ in license_scan.TEMPLATES:
        for other, second, _ in license_scan.TEMPLATES:
            assert {label, other} <= set(index.scan(f"{template}.\n{second}")[5].split(","))
    opening = "MIT License\n\nPermission is hereby granted, free of charge, to any person obtaining a copy of this software and associated documentation files (the \"Software\"), to deal"
    assert index.scan(opening)[5] == "mit" == index.scan("// SPDX-License-Identifier: MIT")[5]
    rng = random.Random(4)
    for _ in range(300):
        w = license_scan.words_of(" ".join(" ".join(x for x in rng.choice(list(texts.values())).split() if rng.random() < 0.9) for _ in range(4)))
        labels, score = set(), 0.0
        for label, template, key in license_scan.TEMPLATES:
            t, k = template.encode().split(), key.encode().split()
            at = next(i for i in range(len(t)) if t[i : i + len(k)] == k)
            for start in range(-len(t), len(w)):
                share = sum(index.idf[x] for i, x in enumerate(t) if 0 <= start + i < len(w) and w[start + i] == x) / sum(index.idf[x] for x in t)
                if start + at >= 0 and w[start + at : start + at + len(k)] == k and share >= license_scan.ENOUGH:
                    labels.add(label)
                    score = max(score, share)
        found = index.scan(b" ".join(w).decode())
        assert set(found[5].split(",")) - {""} - set(license_scan.BASE.values()) == labels
        assert found[6] == 1.0 if found[4] else abs(found[6] - score) < 1e-12


def test_piece_bpe(docs, none, rows):
    import public_tokenizers
    import sentencepiece

    path = public_tokenizers.path("piece_bpe_32k.model")
    sp = sentencepiece.SentencePieceProcessor(model_file=path)

    def plain(text):
        ids = [*sp.encode(text or ""), sp.eos_id()]
        return len(ids), " ".join(map(str, ids)), sp.decode(ids)

    found = piece_bpe.encode_pieces(docs, path)
    assert by_row(found, rows, "n_tokens", "ids", "decoded") == sorted(repr((r[0], *plain(r[1]))) for r in rows)
    assert piece_bpe.encode_pieces(none, path).count() == 0


def test_piece_bpe_odd_texts():
    import public_tokenizers
    import sentencepiece

    path = public_tokenizers.path("piece_bpe_32k.model")
    sp, model = sentencepiece.SentencePieceProcessor(model_file=path), piece_bpe.PieceModel(path)
    rng = random.Random(1)
    alphabet = "  aabehtn\n\t▁é漢😀́.,'\"<0x41> \0"
    texts = ["", " ", "   ", "▁ ▁▁", "aaaaaaaa", "<s>", "</s> a", " " * 40 + "x"] + ["".join(rng.choice(alphabet) for _ in range(rng.randint(1, 60))) for _ in range(2000)]
    for text, (ids, n, decoded) in zip(texts, model.encode_batch(texts), strict=True):
        want = [*sp.encode(text), sp.eos_id()]
        assert ids == " ".join(map(str, want)) and n == len(want)
        assert decoded == sp.decode(want) == model.decode(want)


def test_best_fit(docs, none, rows):
    import public_tokenizers
    from tokenizers import Tokenizer

    path = public_tokenizers.path("word_bpe_49k.json")
    tokenizer = Tokenizer.from_file(path)
    capacity = 256
    found = best_fit.pack_documents(docs, path, capacity).collect()
    want = Counter()
    total = 0
    for r in rows:
        ids = tokenizer.encode(r[1] or "", add_special_tokens=False).ids + [0]
        total += len(ids)
        for p, k in enumerate(range(0, len(ids), capacity)):
            part = ids[k : k + capacity]
            want[r[0], p, k, len(part), zlib.crc32(np.array(part, "<u4").tobytes())] += 1
    assert Counter((r["doc_id"], r["piece"], r["start"], r["length"], r["ids_crc32"]) for r in found) == want
    bins = {}
    for r in found:
        bins.setdefault(r["sequence_id"], []).append((r["offset"], r["length"]))
    for parts in bins.values():
        end = 0
        for offset, length in sorted(parts):
            assert offset == end
            end += length
        assert end <= capacity
    sizes = np.array([r["length"] for r in found])
    assert len(bins) == best_fit.lower_bound(sizes, capacity) >= -(-total // capacity)
    assert all(r["certified"] for r in found)
    assert best_fit.pack_documents(none, path).count() == 0


def test_word_tokenizer():
    """Ids of the library, also of added tokens in any case, odd letters, contractions and words that fall out of the cache."""
    import public_tokenizers
    from tokenizers import Tokenizer

    path = public_tokenizers.path("word_bpe_49k.json")
    library, own = Tokenizer.from_file(path), best_fit.WordTokenizer(path)
    assert own.by_word
    rng = random.Random(2)
    texts = ["<|ENDOFTEXT|> a", "<|EndOfText|>", "x<|STARTOFTEXT|>y.", "<|startoftext|>x", "a<|endoftext|>.", "<|endoftext|", "Straße ſ ẞ İ K Å", "ΑΣ Σας", "don't it's WE'LL 'S a'd", "a\tb\xa0c\x1cd", "½ ²x 12", "é ́a", "", " \n\n ", "x" * 300]
    texts += ["".join(rng.choice("aAbé ÉßÀ×.,!'<|>\t\n\r\xa0ſİΣς1²日😀́x") for _ in range(rng.randint(1, 30))) for _ in range(2000)]
    want = [np.array(library.encode(t, add_special_tokens=False).ids, "<u4").tobytes() for t in texts]
    for _ in range(2):
        assert list(own.ids(texts)) == want
        own.old, own.young = own.young, {}


def test_word_tokenizer_learns_at_once():
    """The new words of a slice go to the library in one call; words that spell the mark of the end, contractions at the edges of texts, slices of an array."""
    import pyarrow as pa
    import public_tokenizers
    from tokenizers import Tokenizer

    path = public_tokenizers.path("word_bpe_49k.json")
    library, own = Tokenizer.from_file(path), best_fit.WordTokenizer(path)
    rng = random.Random(3)
    words = ["".join(rng.choice("abehntéÉßüñ") for _ in range(rng.randint(1, 12))) for _ in range(3000)]
    edges = ["x'", "s y", "'", "re", "a'r", "e", "''s 'sa 'll'", "!'s", "1'd2", "</w> a</w>b w>", "café's l'été", "a×b c÷d É×", "'s", "", None, "Tf<", "|Qf <", "\x00'S 'Sé \x0bb", "日's 's"]
    texts = [None, *edges, *edges[::-1], *[" ".join(words[k : k + 30]) for k in range(0, 3000, 30)], "end'"]
    want = [np.array(library.encode(t or "", add_special_tokens=False).ids, "<u4").tobytes() for t in texts]
    learn, calls = own.learn, []
    own.learn = lambda words: calls.append(len(words)) or learn(words)
    column = pa.array(["before", *texts], pa.string())[1:]
    for size in (10**9, 500, 1):
        parts = list(best_fit.text_slices(column, size))
        calls.clear()
        assert [b for part in parts for b in own.ids(part)] == want
        assert sum(map(len, parts)) == len(texts) and sum(calls) < len(set(words)) * 2
        own.old, own.young = {}, {}
        if size == 10**9:
            assert len(parts) == 1 and max(calls) >= len({w.lower() for w in words})
    assert list(best_fit.text_slices(column[:0], 10)) == []
    own.by_word = False
    assert list(own.ids(next(best_fit.text_slices(column, 10**9)))) == want


def test_best_fit_exchange(spark):
    """Pieces of all partitions with room are packed again until the total meets its bound; equal rows are dealt apart; clashing names."""
    rng = random.Random(8)
    sizes = [rng.randint(1, 60) for _ in range(300)] + [rng.randint(1, 8) for _ in range(600)] + [7] * 300
    pieces = spark.createDataFrame([(None, 0, s, 1, 2, 3, 4, 5) for s in sizes], "doc_id long, piece int, length long, deal int, size int, offset int, open int, x_0 int")
    out = best_fit.pack(pieces, 100, at_once=100)
    assert sorted(out.columns) == sorted([*pieces.columns, "sequence_id", "certified"])
    found = out.collect()
    assert sorted(r["length"] for r in found) == sorted(sizes) and all(r["certified"] and r["deal"] == 1 and r["size"] == 2 for r in found)
    assert len({r["sequence_id"] for r in found}) == -(-sum(sizes) // 100) == best_fit.lower_bound(np.array(sizes), 100)


def test_best_fit_rounds(spark):
    """Partitions with gaps exchange pieces; nothing is lost, and no more bins come out than without."""
    rng = random.Random(4)
    sizes = [rng.choice([30, 45, 52, 55, 70]) for _ in range(600)]
    pieces = spark.createDataFrame([(k, 0, s) for k, s in enumerate(sizes)], "doc_id long, piece int, length long")
    once = best_fit.pack(pieces, 100, rounds=1, at_once=60)
    more = best_fit.pack(pieces, 100, rounds=4, at_once=60)
    assert sorted(r["doc_id"] for r in more.collect()) == list(range(600))
    load = more.groupBy("sequence_id").agg(F.sum("length").alias("n"))
    assert load.where("n > 100").count() == 0
    assert best_fit.lower_bound(np.array(sizes), 100) <= load.count() <= once.select("sequence_id").distinct().count()
    assert best_fit.lower_bound(np.array([51] * 7), 100) == 7


def test_media_columns(spark, docs, none, rows, tmp_path):
    def run(table, name):
        table.write.parquet(f"{tmp_path}/{name}/documents.parquet")
        return media_columns.op7_media_columns(spark, f"{tmp_path}/{name}")

    found = run(docs, "a")
    want = []
    for r in rows:
        data = (r[1] or "").encode()
        full = max(64, -(-len(data) // 64) * 64)
        payload = data.ljust(full, b"\0")
        media = f"P5\n64 {full // 64}\n255\n".encode() + payload
        want.append(repr((r[0], len(data), full, hashlib.sha256(payload).hexdigest(), zlib.crc32(payload[-64:]), len(media), hashlib.sha256(media).hexdigest())))
    assert by_row(found, rows, "n_bytes", "payload_bytes", "payload_sha256", "tail_crc32", "media_bytes", "media_sha256") == sorted(want)
    features = {}
    for r in found.collect():
        features.setdefault(r["payload_sha256"], set()).add(r["feature"])
    assert all(len(v) == 1 and None not in v for v in features.values())
    assert run(none, "b").count() == 0


def test_interleaved_html(spark):
    html = '<p>one &amp; two</p><script>no()</script><figure><img src="sha256:aa" alt="old"><figcaption>cap</figcaption></figure>tail<img src="http://x" alt="y"><p>'
    pages = spark.createDataFrame([(1, html), (2, None), (3, ""), (1, "<b>x")], "page_id long, html string")
    got = [tuple(r) for r in media_columns.interleave(pages, "page_id", "html").orderBy("id", "text", "position").collect()]
    assert sorted(got, key=repr) == sorted([(1, 0, "text", "one & two", None, None), (1, 1, "media", None, "aa", "cap"), (1, 2, "text", "tail", None, None), (1, 3, "media", None, None, "y"), (1, 0, "text", "x", None, None)], key=repr)


PAGES = "page_id long, url string, html string"


def test_warc(spark, tmp_path):
    big, other = "<p>é" + "a" * 1500, "<p>" + "b" * 2000
    rows = [(1, "u", big), (2, None, big), (3, "x\r\ny", big), (4, "u", other), (5, "u", None), (6, "u", ""), (7, "u", "small"), (8, "u", "small"), (3, "x", big), (None, "u", big), (9, "u", "z" * 300_000)]
    clashing(spark.createDataFrame(rows, PAGES)).repartition(2).write.parquet(f"{tmp_path}/a/pages.parquet")
    got = sorted(repr(tuple(r)) for r in warc.op1_warc(spark, f"{tmp_path}/a").select("page_id", "payload_bytes", "payload_digest", "record_type", "refers_to", "intact").collect())
    want = []
    for page, _, html in rows:
        data = (html or "").encode()
        revisit = len(data) >= 1000 and html == big and page != 3
        want.append(repr((page, len(data), hashlib.sha1(data).hexdigest(), "revisit" if revisit else "response", 3 if revisit else None, True)))
    assert got == sorted(want)
    spark.createDataFrame([], PAGES).write.parquet(f"{tmp_path}/b/pages.parquet")
    assert warc.op1_warc(spark, f"{tmp_path}/b").count() == 0


def test_warc_files_are_gzip_members(spark, tmp_path):
    import glob
    import gzip

    rows = [(k, f"http://x/{k}", "<p>" + "word " * (300 + k)) for k in range(40)]
    pages = spark.createDataFrame(rows, PAGES).select("page_id", "url", F.encode("html", "UTF-8").alias("payload"))
    raw = warc.write_archives(warc.with_revisits(pages), f"{tmp_path}/raw", limit=20_000)
    raw.write.parquet(f"{tmp_path}/raw-list")
    raw = spark.read.parquet(f"{tmp_path}/raw-list")
    assert raw.count() > 2
    done = warc.normalise(raw, f"{tmp_path}/out")
    done.write.parquet(f"{tmp_path}/done-list")
    for path in glob.glob(f"{tmp_path}/out/*.warc.gz"):
        whole = gzip.open(path).read()
        assert whole == gzip.open(path.replace("/out/", "/raw/")).read()
        with open(path, "rb") as f, open(f"{path}.idx") as index:
            for line in index.read().split("\n"):
                offset, length = map(int, line.split("\t")[:2])
                f.seek(offset)
                assert gzip.decompress(f.read(length)).startswith(b"WARC/1.1\r\n")
    assert warc.read_archives(spark.read.parquet(f"{tmp_path}/done-list")).where("intact").count() == 40


VECTORS = "vec_id long, embedding array<float>, label int"


def test_multi_index(spark, tmp_path):
    rng = np.random.default_rng(2)
    x = rng.normal(size=(400, 8)).astype(np.float32)
    x[50:170] = x[50]  # a group of equal vectors
    rows = [(k, v.tolist(), 0) for k, v in enumerate(x)]
    bad = [(1000, None, 0), (1001, [0.0] * 8, 0), (1002, [1.0, None] + [0.5] * 6, 0), (1003, [float("nan")] * 8, 0), (1004, [float("inf")] * 8, 0), (1005, [1.0], 0), (None, [1.0] * 8, 0), (7, x[7].tolist(), 0)]
    clashing(spark.createDataFrame(rows + bad, VECTORS)).write.parquet(f"{tmp_path}/a/embeddings.parquet")
    got = {}
    cleaned = multi_index.clean(spark.read.parquet(f"{tmp_path}/a/embeddings.parquet"), "vec_id", "embedding")
    for r in multi_index.MultiIndex(cleaned, 20).search(cleaned.where("id % 20 = 0"), share=1.0).orderBy("query_id", "rank").collect():
        got.setdefault(r["query_id"], []).append((r["rank"], r["vec_id"], r["score"]))
    d = x.astype(np.float64)
    for q in range(0, 400, 20):
        s = d @ d[q]
        order = [k for k in np.lexsort((np.arange(400), -np.round(s, 12))) if k != q][:20]
        assert [r for r, _, _ in got[q]] == list(range(1, 21))
        assert [v for _, v, _ in got[q]] == order
        assert np.allclose([c for _, _, c in got[q]], s[order], rtol=0, atol=1e-12)
    assert set(got) == set(range(0, 400, 20))
    spark.createDataFrame([], VECTORS).write.parquet(f"{tmp_path}/b/embeddings.parquet")
    assert multi_index.op3_multi_index(spark, f"{tmp_path}/b").count() == 0
    spark.createDataFrame(rows[:5], VECTORS).write.parquet(f"{tmp_path}/c/embeddings.parquet")
    assert multi_index.op3_multi_index(spark, f"{tmp_path}/c").count() == 4


@pytest.mark.parametrize("sf", ["0.01", "0.1"])
def test_multi_index_recall(spark, sf):
    """The registered query, as it is, against brute force."""
    rows = multi_index.clean(spark.read.parquet(f"/root/testdata/sf{sf}/embeddings.parquet"), "vec_id", "embedding")
    found = multi_index.op3_multi_index(spark, f"/root/testdata/sf{sf}").collect()
    part = rows.orderBy("id").toPandas()
    x, ids = np.stack(part["v"].to_numpy()), part["id"].to_numpy()
    got = {}
    for r in found:
        got.setdefault(r["query_id"], set()).add(r["vec_id"])
    hit = total = 0
    for n in np.flatnonzero(ids % 20 == 0):
        s = x @ x[n]
        s[n] = -np.inf
        assert len(got[ids[n]]) == 20
        hit += len(got[ids[n]] & set(ids[np.argsort(-s, kind="stable")[:20]].tolist()))
        total += 20
    assert hit / total >= 0.9


def test_multi_index_walks_little_where_vectors_cluster(spark):
    rng = np.random.default_rng(3)
    x = (np.repeat(rng.normal(size=(100, 16)), 40, axis=0) + 0.05 * rng.normal(size=(4000, 16))).astype(np.float32)
    rows = multi_index.clean(spark.createDataFrame([(k, v.tolist(), 0) for k, v in enumerate(x)], VECTORS), "vec_id", "embedding")
    assert multi_index.MultiIndex(rows, 20).share < 0.05


def brute_components(rows, n=5, percent=80):
    low = str.maketrans({chr(c): chr(c + 32) for c in range(65, 91)})
    sets = []
    for _, text, *_ in rows:
        w = re.findall(r"[^\x20\x09-\x0D]+", (text or "").translate(low))
        sets.append({tuple(w[k : k + n]) for k in range(len(w) - n + 1)} if len(w) >= n else ({tuple(w)} if w else set()))
    root = list(range(len(rows)))

    def find(k):
        while root[k] != k:
            k = root[k]
        return k

    for a in range(len(rows)):
        for b in range(a):
            if sets[a] and sets[b] and 100 * len(sets[a] & sets[b]) >= percent * len(sets[a] | sets[b]):
                root[find(a)] = find(b)
    low_id = {}
    for k, r in enumerate(rows):
        if r[0] is not None:
            low_id[find(k)] = min(low_id.get(find(k), r[0]), r[0])
    return [(r[0], len(sets[k]), None if r[0] is None else low_id[find(k)]) for k, r in enumerate(rows)]


def test_ngram_join(docs, none, rows):
    found = ngram_join.near_duplicates(docs)
    assert by_row(found, rows, "n_shingles", "component_id") == sorted(map(repr, brute_components(rows)))
    assert ngram_join.near_duplicates(none).count() == 0


@pytest.mark.parametrize("most", [ngram_join.BLOCK_TOKENS, 2_000])
def test_ngram_join_clusters(spark, monkeypatch, most):
    """Near copies of near copies, more than a block of them, and unlinked texts that share a passage; with blocks bounded by documents and by tokens."""
    monkeypatch.setattr(ngram_join, "BLOCK_TOKENS", most)
    rng = random.Random(9)
    stock = [f"w{k}" for k in range(4000)]
    origin = [rng.choice(stock) for _ in range(150)]
    texts = []
    for _ in range(300):
        t = list(origin)
        for _ in range(rng.randint(0, 5)):
            t[rng.randrange(len(t))] = rng.choice(stock)
        texts.append(" ".join(t))
    passage = [rng.choice(stock) for _ in range(60)]
    texts += [" ".join([rng.choice(stock) for _ in range(40)] + passage) for _ in range(200)]
    rows = [(k * 3, t, "en", "s", 1) for k, t in enumerate(texts)]
    found = ngram_join.near_duplicates(spark.createDataFrame(rows, DOCUMENTS))
    assert by_row(found, rows, "n_shingles", "component_id") == sorted(map(repr, brute_components(rows)))


def test_one_of_each(docs, rows):
    kept = ngram_join.one_of_each(docs)
    assert kept.columns == docs.columns
    ids = [r["doc_id"] for r in kept.collect()]
    want = {d for d, _, c in brute_components(rows) if d is None or d == c}
    assert set(ids) == want and len(ids) == len(want)


def test_one_of_each_of_repeated_ids(spark):
    """An id that several texts have: each text links on its own, and only rows of linked texts go."""
    rng = random.Random(6)
    a, b, c = (words(rng, 40, [f"w{k}" for k in range(500)]) for _ in range(3))
    rows = [(3, a), (7, a), (7, b), (7, c), (5, c), (9, b), (8, "x y"), (8, "x y"), (8, None), (None, a), (None, None), (4, "")]
    docs = spark.createDataFrame([(i, t, 1, 2, "k") for i, t in rows], "doc_id long, text string, __doc int, component_id int, text_key string")
    found = Counter((r["doc_id"], r["n_shingles"] > 0, r["component_id"]) for r in ngram_join.near_duplicates(docs).collect())
    want = [(3, True, 3), (7, True, 3), (7, True, 7), (7, True, 5), (5, True, 5), (9, True, 7), (8, True, 8), (8, True, 8), (8, False, 8), (None, True, None), (None, False, None), (4, False, 4)]
    assert found == Counter(want)
    kept = ngram_join.one_of_each(docs)
    assert kept.columns == docs.columns
    want = [(3, a), (7, b), (5, c), (8, "x y"), (8, None), (None, a), (None, None), (4, "")]
    assert Counter((r["doc_id"], r["text"]) for r in kept.collect()) == Counter(want)


def test_heads_hold_every_link():
    """Of any two linked sets, enough of the first common tokens stand in both heads."""
    rng = np.random.default_rng(1)
    for percent in (80, 50, 95):
        for _ in range(400):
            n = int(rng.integers(1, 60))
            a = rng.choice(2000, n, replace=False)
            b = np.unique(np.r_[rng.choice(a, int(rng.integers(0, n + 1)), replace=False), rng.choice(2000, int(rng.integers(0, 12)), replace=False)])
            shared = len(np.intersect1d(a, b))
            if 100 * shared >= percent * len(np.union1d(a, b)):
                x, y = (np.sort(s)[: ngram_join.head(len(s), percent)] for s in (a, b))
                both = len(np.intersect1d(x, y))
                for size in (len(a), len(b)):
                    assert both >= ngram_join.few(ngram_join.need(size, percent), percent) >= 1


def brute_removal(rows, length=200):
    raw = [(r[1] or "").encode() for r in rows]
    seen = Counter(b[k : k + length] for b in raw for k in range(len(b) - length + 1))
    out = []
    for r, b in zip(rows, raw, strict=True):
        gone = np.zeros(len(b) + 1, bool)
        for k in range(len(b) - length + 1):
            if seen[b[k : k + length]] > 1:
                gone[k : k + length] = True
        runs = int((np.diff(np.r_[False, gone].astype(np.int8)) == 1).sum())
        left = bytes(np.frombuffer(b, np.uint8)[~gone[:-1]])
        out.append((r[0], len(b), len(b) - len(left), runs, hashlib.sha256(left).hexdigest()))
    return out


def test_suffix_dedup(docs, none, rows):
    found = suffix_dedup.remove_repeats(docs)
    assert by_row(found, rows, "n_bytes", "n_removed", "n_spans", "kept_sha256") == sorted(map(repr, brute_removal(rows)))
    assert suffix_dedup.remove_repeats(none).count() == 0


def test_suffix_dedup_hot_anchors(docs, rows, monkeypatch):
    monkeypatch.setattr(suffix_dedup, "HOT", 1)
    monkeypatch.setattr(suffix_dedup, "RANGE", 5)
    found = suffix_dedup.remove_repeats(docs)
    assert by_row(found, rows, "n_bytes", "n_removed", "n_spans", "kept_sha256") == sorted(map(repr, brute_removal(rows)))


def test_suffix_dedup_many_ranges(docs, rows, monkeypatch):
    monkeypatch.setattr(suffix_dedup, "RANGE", 2)
    found = suffix_dedup.remove_repeats(docs)
    assert by_row(found, rows, "n_bytes", "n_removed", "n_spans", "kept_sha256") == sorted(map(repr, brute_removal(rows)))


def test_suffix_dedup_segments(docs, rows, monkeypatch):
    """Texts longer than a segment, and more ranges than splitters."""
    monkeypatch.setattr(suffix_dedup, "SEGMENT", 150)
    monkeypatch.setattr(suffix_dedup, "RANGE", 2)
    monkeypatch.setattr(suffix_dedup, "SPLITTERS", 3)
    found = suffix_dedup.remove_repeats(docs)
    assert by_row(found, rows, "n_bytes", "n_removed", "n_spans", "kept_sha256") == sorted(map(repr, brute_removal(rows)))


def test_suffix_dedup_equal_rows(spark):
    """The work is in proportion to rows that are equal in id and text."""
    rng = random.Random(5)
    text, other = words(rng, 500), words(rng, 80)
    rows = [(1, text, "en", "s", 1)] * 3000 + [(2, text[:900] + other, "en", "s", 1), (None, text, "en", "s", 1)]
    found = suffix_dedup.remove_repeats(spark.createDataFrame(rows, DOCUMENTS).repartition(4))
    got = Counter((r["doc_id"], r["n_removed"], r["n_spans"]) for r in found.collect())
    size = len(text.encode())
    assert got[1, size, 1] == 3000 and got[None, size, 1] == 1 and sum(got.values()) == len(rows)


def test_merge_runs():
    rng = random.Random(5)
    for k in (1, 2, 3, 7):
        runs = [sorted(bytes(rng.choice(b"ab") for _ in range(rng.randint(0, 12))) for _ in range(rng.randint(0, 30))) for _ in range(k)]
        got = list(suffix_dedup.merge_runs([suffix_dedup.front_decode(suffix_dedup.front_code(r)) for r in runs]))
        merged = [s for _, _, s in got]
        assert merged == sorted(x for r in runs for x in r)
        for a, (_, share, b) in zip(merged, got[1:], strict=False):
            assert share == suffix_dedup.common(a, b, 0)


def test_thinned_documents(docs, rows):
    out = suffix_dedup.thinned_documents(docs)
    assert out.columns == docs.columns and out.count() == len(rows)
    assert out.where("n_chars <> length(text)").count() == 0


def test_training_samples_of_one_id(spark, monkeypatch):
    """The documented bounds hold for rows, not for ids."""
    texts = [f"wort{k} das ist ein satz {k}" + " mehr" * (k % 300) for k in range(3000)]
    same = spark.createDataFrame([(1, t, "de", "s0", 5) for t in texts] + [(1, texts[0], "de", "s0", 5)] * 500, DOCUMENTS)
    seen = []
    monkeypatch.setattr(language_crf, "fit", lambda t, y: seen.append(len(t)))
    language_crf.train(same)
    monkeypatch.setattr(quality_bayes, "TRAIN_ROWS", 100)
    monkeypatch.setattr(quality_bayes, "fit", lambda x, y: seen.append(len(x)))
    quality_bayes.train(same, spark.createDataFrame([(1, 1, 0)], LABELS))
    assert seen == [language_crf.TRAIN_DOCS, 100]


def test_language_crf(docs, none, rows):
    model = language_crf.train(docs)
    found = language_crf.label_documents(docs, model)
    got = [r.asDict() for r in found.collect()]
    assert len(got) == len(rows)
    text_of = {r[0]: r[1] for r in rows}
    for r in got:
        text = text_of[r["doc_id"]]
        bare = text is None or not any(c.isalpha() for c in text)
        assert (r["lang_pred"] == "und") == bare and 0 <= r["score"] <= 1
        assert bare or r["lang_pred"] in ("en", "de")
    empty = language_crf.train(none)
    assert language_crf.label_documents(none, empty).count() == 0
    assert {r["lang_pred"] for r in language_crf.label_documents(docs, empty).collect()} == {"und"}
    kept = language_crf.kept_documents(docs)
    assert kept.columns == docs.columns and kept.where("text is null or text = ''").count() == 0


def test_language_crf_held_out(spark, sf_dir):
    docs = spark.read.parquet("/root/testdata/sf0.01/documents.parquet")
    found = language_crf.op2_language_crf(spark, "/root/testdata/sf0.01").join(docs.select("doc_id", "lang"), "doc_id").where("held_out").toPandas()
    assert (found["lang"] == found["lang_pred"]).mean() > 0.98
    assert all(zlib.crc32(str(d).encode()) % 4 == 2 for d in found["doc_id"])


def test_forward_backward_by_segments():
    rng = np.random.default_rng(0)
    model = language_crf.LanguageCrf(["a", "b", "c"], np.empty(0, np.uint64), np.zeros((1, 3)), rng.normal(size=(3, 3)))
    sizes = np.array([1, 40, 0, 13, 29])
    score = rng.normal(size=(sizes.sum(), 3)) * 2
    whole, cut = model.posteriors(score, sizes, segment=64), model.posteriors(score, sizes, segment=4)
    assert np.allclose(whole, cut)
    # One text of four words by enumeration.
    import itertools

    s, total = score[:4], np.zeros((4, 3))
    for path in itertools.product(range(3), repeat=4):
        w = np.exp(sum(s[k, y] for k, y in enumerate(path)) + sum(model.transitions[a, b] for a, b in zip(path, path[1:], strict=False)))
        for k, y in enumerate(path):
            total[k, y] += w
    assert np.allclose(model.posteriors(s, np.array([4])), total / total.sum(axis=1, keepdims=True))


LABELS = "doc_id long, quality int, toxic int"


def test_quality_bayes(spark, docs, none, rows):
    labels = spark.createDataFrame([(k, int(k % 5 > 0), 0) for k in range(0, 60)] + [(None, 1, 0), (3, None, 0), (4, 1, None), (4, 1, None)], LABELS)
    found = quality_bayes.judge(docs, labels)
    got = [r.asDict() for r in found.collect()]
    assert len(got) == len(rows)
    text_of = {r[0]: r[1] for r in rows}
    for r in got:
        assert 0 <= r["p"] <= 1 and 0 <= r["p_path"] <= 1
        assert (text_of[r["doc_id"]] or "").strip() or not r["keep"]
    kept = quality_bayes.kept_documents(docs, labels)
    assert kept.columns == docs.columns
    assert kept.count() == sum(r["keep"] for r in got)
    assert quality_bayes.judge(none, labels).count() == 0
    bare = quality_bayes.judge(docs, spark.createDataFrame([], LABELS)).collect()
    assert all(r["keep"] == bool((text_of[r["doc_id"]] or "").strip()) for r in bare)


def test_quality_bayes_separates(spark):
    sf = "/root/testdata/sf0.01"
    found = quality_bayes.op5_quality_bayes(spark, sf).join(spark.read.parquet(f"{sf}/labels.parquet"), "doc_id").toPandas()
    good, bad = found[found["quality"] == 1], found[found["quality"] == 0]
    assert good["keep"].mean() > 0.97 and bad["keep"].mean() < 0.1


def test_site_posteriors_shrink(spark):
    rows = [(k, "big", "big/en", 0.9) for k in range(200)] + [(k, "bad", "bad/en", 0.1) for k in range(200)] + [(1, "tiny", "tiny/en", 0.1)]
    sites, whole = quality_bayes.site_posteriors(spark.createDataFrame(rows, "doc_id long, host string, path string, p_document double"))
    p = {r["host"]: r for r in sites.collect()}
    assert p["bad"]["p_path"] < p["tiny"]["p_path"] < whole < p["big"]["p_path"]


def plain_posteriors(scored, most_shift, keep):
    """Sites by loops over the documents (doc_id, host, path, p_document), in the order given: (p_host, p_path, p, keep)."""
    mean = lambda x: sum(x) / len(x)
    whole = mean([r[3] for r in scored])
    of_host, of_path = {}, {}
    for _, host, path, p in scored:
        of_host.setdefault(host, []).append(p)
        of_path.setdefault((host, path), []).append(p)

    def strength(groups, parent_of):
        sizes = [len(x) for x in groups.values()]
        n, free = sum(sizes), sum(sizes) - len(sizes)
        if len(sizes) < 2 or not free:
            return 10.0
        within = sum((v - mean(x)) ** 2 for x in groups.values() for v in x) / free
        apart = n - sum(s * s for s in sizes) / n
        between = (sum(len(x) * (mean(x) - parent_of(k)) ** 2 for k, x in groups.items()) - (len(sizes) - 1) * within) / apart
        return min(max(within / between, 1.0), 1e6) if between > 1e-9 else 1e6

    k = strength(of_host, lambda _: whole)
    p_host = {h: (sum(x) + k * whole) / (len(x) + k) for h, x in of_host.items()}
    k = strength(of_path, lambda key: p_host[key[0]])
    p_path = {key: (sum(x) + k * p_host[key[0]]) / (len(x) + k) for key, x in of_path.items()}
    logit = lambda p: math.log(min(max(p, 1e-6), 1 - 1e-6) / (1 - min(max(p, 1e-6), 1 - 1e-6)))
    out = []
    for _, host, path, p in scored:
        shift = min(max(logit(p_path[host, path]) - logit(whole), -most_shift), most_shift)
        final = 1 / (1 + math.exp(-(logit(p) + shift))) if p > 0 else 0.0
        out.append((p_host[host], p_path[host, path], final, final >= keep))
    return out


def test_quality_bayes_against_plain_posteriors(spark):
    """Every document of a whole table: hot and sparse sites, hosts of one path and of several, repeated rows."""
    rng = np.random.default_rng(5)
    rows = []
    for k in range(3_000):
        host = "hot" if k % 3 == 0 else f"h{int(rng.integers(40))}" if k % 50 else f"rare{k}"
        good = 0.9 if host == "hot" else (sum(host.encode()) % 10) / 10
        rows.append((k if k % 100 else 0, host, f"{host}/{k % 2}", float(np.clip(rng.normal(good, 0.2), 0, 1)), k))
    scored = spark.createDataFrame(rows, "doc_id long, host string, path string, p_document double, row int")
    got = {r["row"]: r for r in quality_bayes._with_posterior(scored, *quality_bayes.site_posteriors(scored)).collect()}
    wanted = plain_posteriors([r[:4] for r in rows], quality_bayes.MOST_SHIFT, quality_bayes.KEEP)
    assert len(got) == len(rows)
    for r, w in zip(rows, wanted, strict=True):
        found = got[r[4]]
        assert np.allclose([found["p_host"], found["p_path"], found["p"]], w[:3], rtol=1e-7, atol=1e-9)
        assert found["keep"] == w[3]


def test_shape_features_against_plain_counts():
    """The features of odd texts by loops over their words and lines."""
    texts = ["", "a", "The cat. The cat!", "x\n\nx\ny z y z", "ÄÖ £ -- ((a)) 12 12 12", " \t lead\n", "UP up, 3.5 <b>", "one\n" * 7]
    got = quality_bayes.shape_features(texts)
    share = lambda raw, members: sum(b in members for b in raw) / max(len(raw), 1)
    for text, row in zip(texts, got, strict=True):
        raw = text.encode()
        words = re.findall(rb"[^\x00-\x20]+", raw)
        lines = [x for x in raw.split(b"\n") if x]
        many, n = max(len(words), 1), len(words)
        top = max((words.count(w) for w in words), default=0)
        twice = sum(a == b for a, b in zip(sorted(lines), sorted(lines)[1:], strict=False))
        plain = [
            math.log1p(n), sum(map(len, words)) / many, share(raw, quality_bayes.UPPER), share(raw, quality_bayes.DIGIT), share(raw, quality_bayes.SYMBOL), share(raw, quality_bayes.STOP),
            sum(words[k] == words[k - 1] for k in range(1, n)) / many, sum(words[k] == words[k - 2] for k in range(2, n)) / many, len(set(words)) / many, top / many,
            twice / max(len(lines), 1), sum(len(w) <= 2 for w in words) / many, n / max(len(lines), 1), sum(sum(b in quality_bayes.SYMBOL for b in w) >= 2 for w in words) / many,
        ]
        assert np.allclose(row, plain), (text, [x for x in zip(quality_bayes.NAMES, row, plain, strict=True) if abs(x[1] - x[2]) > 1e-9])


def test_every_operator_is_registered():
    assert sorted(int(re.match(r"op(\d+)_", n)[1]) for n in queries.QUERIES) == list(range(1, 14))
