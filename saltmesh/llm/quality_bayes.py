"""Document quality by hierarchical empirical Bayes.

A document classifier (logistic regression on shape features of the whole text, each cut at the sample's quantiles)
gives each document a probability. Sites are hosts (`source`) and below them paths (`source` and `lang`); a site's
posterior is its documents' mean, shrunk toward its parent: paths to their host, hosts to the whole corpus. How far is
estimated from the spread of the sites (method of moments), so sparse sites stay near their parent. A document's final
log-odds are those of the classifier, moved by what its path differs from the corpus.

The classifier is fitted on at most TRAIN_ROWS labelled documents, drawn by a hash of their ids; every count and mean of
sites is over all documents, with partial sums before the shuffle, so one site may hold any share of the rows.

Defined results: null or empty text, or text without a word, has p_document 0 and is rejected. Null hosts and languages
are sites of their own. Without labels of both kinds every document with words has p_document 0.5 and is kept. Repeated
rows are judged each on their own; extra columns are ignored; an empty table gives an empty result.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .bytehash import Prefix
from .shared import keep_only, slices, stored, table

TRAIN_ROWS, BINS, ROUNDS = 4_000, 8, 400
#: Log-odds that a site can add or take are held to this, so that a site alone rejects no clear document.
MOST_SHIFT = 1.0
#: Documents below this probability are rejected. Junk is far below it; short clean texts may lie under a half.
KEEP = 0.2

NAMES = ("words", "word_chars", "upper", "digit", "symbol", "stop", "repeat_next", "repeat_second", "distinct", "top_word", "line_repeat", "short_words", "line_words", "mark_words")

# Character classes of ASCII bytes.
UPPER, DIGIT, STOP, SYMBOL = b"ABCDEFGHIJKLMNOPQRSTUVWXYZ", b"0123456789", b".,;:?", b"!#$%&*+-/<=>@\\^_`{|}~\"()[]"


def _class(members: bytes) -> np.ndarray:
    out = np.zeros(256, bool)
    out[list(members)] = True
    return out


_CLASSES = [_class(c) for c in (UPPER, DIGIT, SYMBOL, STOP)]


def shape_features(texts: list[str]) -> np.ndarray:
    """A row of NAMES for each text, over its whole length."""
    raw = [t.encode() for t in texts]
    data = np.frombuffer(b"\n".join([*raw, b""]), np.uint8)
    sizes = np.array([len(r) + 1 for r in raw], np.int64)
    bounds = np.r_[0, np.cumsum(sizes)]
    n = np.maximum(sizes - 1, 1)
    out = np.zeros((len(raw), len(NAMES)))
    if not len(raw):
        return out
    total = lambda flag: np.add.reduceat(flag.astype(np.int64), bounds[:-1])
    word = data > 32
    edge = np.diff(np.r_[False, word, False].astype(np.int8))
    start, end = np.flatnonzero(edge == 1), np.flatnonzero(edge == -1)
    doc = np.searchsorted(bounds, start, side="right") - 1
    per = np.bincount(doc, minlength=len(raw))
    many = np.maximum(per, 1)
    prefix = Prefix(data)
    h = prefix.hash(start, end) if len(start) else np.empty(0, np.uint64)
    mean = lambda flag, where: np.bincount(where, flag, len(raw)) / many
    out[:, 0] = np.log1p(per)
    out[:, 1] = total(word) / many
    for k, table_ in enumerate(_CLASSES):
        out[:, 2 + k] = total(table_[data]) / n
    for k in (1, 2):
        same = (h[k:] == h[:-k]) & (doc[k:] == doc[:-k])
        out[:, 5 + k] = mean(same.astype(float), doc[k:])
    order = np.lexsort((h, doc))
    d, v = doc[order], h[order]
    head = np.flatnonzero(np.r_[True, (d[1:] != d[:-1]) | (v[1:] != v[:-1])]) if len(d) else np.empty(0, np.int64)
    runs = np.diff(np.r_[head, len(d)])
    out[:, 8] = np.bincount(d[head], minlength=len(raw)) / many
    top = np.zeros(len(raw))
    np.maximum.at(top, d[head], runs)
    out[:, 9] = top / many
    line_end = np.flatnonzero(data == 10)
    line_start = np.r_[0, line_end[:-1] + 1]
    line_doc = np.searchsorted(bounds, line_start, side="right") - 1
    lh = prefix.hash(line_start, line_end)
    full = line_end > line_start
    lines = np.maximum(np.bincount(line_doc[full], minlength=len(raw)), 1)
    order = np.lexsort((lh[full], line_doc[full]))
    ld, lv = line_doc[full][order], lh[full][order]
    out[:, 10] = np.bincount(ld[1:], (ld[1:] == ld[:-1]) & (lv[1:] == lv[:-1]), len(raw)) / lines
    out[:, 11] = mean((end - start <= 2).astype(float), doc)
    out[:, 12] = per / lines
    marks = np.r_[0, np.cumsum(_CLASSES[2][data])]
    out[:, 13] = mean((marks[end] - marks[start] >= 2).astype(float), doc)
    return out


@dataclass
class ShapeClassifier:
    """Weights of the bins of each feature."""

    edges: np.ndarray
    weights: np.ndarray
    bias: float

    def bins(self, x: np.ndarray) -> np.ndarray:
        """Numbers of the bins of each row, one for each feature."""
        at = np.stack([np.searchsorted(self.edges[k], x[:, k], side="right") for k in range(x.shape[1])], axis=1)
        return at + np.arange(x.shape[1]) * (BINS + 1)

    def probability(self, x: np.ndarray) -> np.ndarray:
        p = 1 / (1 + np.exp(-np.clip(self.weights[self.bins(x)].sum(axis=1) + self.bias, -30, 30)))
        return np.where(x[:, 0] > 0, p, 0.0)


def fit(x: np.ndarray, y: np.ndarray) -> ShapeClassifier:
    width = len(NAMES)
    model = ShapeClassifier(np.zeros((width, BINS)), np.zeros(width * (BINS + 1)), 0.0)
    if not len(y) or y.min() == y.max():
        return model
    bad = x[y == 0]
    # Quantiles of either kind, so that a rare kind of text has bins of its own.
    half = np.linspace(0.02, 0.98, BINS // 2)
    model.edges = np.sort(np.concatenate([np.quantile(x[y == 1], half, axis=0), np.quantile(bad, half, axis=0)]), axis=0).T
    at = model.bins(x)
    weight = np.where(y == 1, 0.5 / (y == 1).mean(), 0.5 / (y == 0).mean())
    square = np.full(len(model.weights), 1e-3)
    for _ in range(ROUNDS):
        p = 1 / (1 + np.exp(-np.clip(model.weights[at].sum(axis=1) + model.bias, -30, 30)))
        g = weight * (p - y)
        grad = np.bincount(at.ravel(), np.repeat(g, width), len(model.weights)) / len(y) + 1e-4 * model.weights
        square += grad * grad
        model.weights -= 0.3 * grad / np.sqrt(square)
        model.bias -= 0.1 * g.mean()
    return model


def train(docs: DataFrame, labels: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> ShapeClassifier:
    drawn = labels.where("quality is not null and doc_id is not null").select(F.col("doc_id").alias("_id"), F.col("quality").alias("_y")).orderBy(F.xxhash64("_id"), "_id", "_y").limit(TRAIN_ROWS)
    texts = docs.select(F.col(id_col).alias("_id"), F.col(text_col).alias("text"))
    sample = texts.join(F.broadcast(drawn), "_id").select("text", "_id", F.col("_y").alias("y"))
    # Ids may repeat without limit, in either table: the bound holds for rows.
    found = _features(sample, ["_id", "y"]).distinct().orderBy(F.xxhash64("x__id"), "x__id", "x_y", "f").limit(TRAIN_ROWS)
    rows = found.toPandas().sort_values(["x__id", "x_y"], kind="stable")
    x = np.stack(rows["f"].to_numpy()) if len(rows) else np.zeros((0, len(NAMES)))
    return fit(x, rows["x_y"].to_numpy().astype(float))


def _features(docs: DataFrame, keep: list[str]) -> DataFrame:
    """(f array<double>, x_<column> of each in keep) for docs with text."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            x = np.concatenate([np.zeros((0, len(NAMES))), *(shape_features(part) for part in slices(batch.column(0).to_pylist()))])
            lists = pa.ListArray.from_arrays(pa.array(np.arange(len(x) + 1, dtype=np.int32) * len(NAMES)), pa.array(x.ravel()))
            yield pa.RecordBatch.from_arrays([lists, *batch.columns[1:]], ["f", *(f"x_{k}" for k in keep)])

    rows = docs.select(F.col("text").cast("string").alias("text"), *(F.col(k).alias(f"x_{k}") for k in keep))
    schema = "f array<double>" + "".join(f", `{f.name}` {f.dataType.simpleString()}" for f in rows.schema[1:])
    return rows.mapInArrow(run, schema)


def evidence(docs: DataFrame, model: ShapeClassifier, carry: list[str] | None = None) -> DataFrame:
    """(doc_id, host, path, p_document), and the columns named in carry as x_0, x_1 and so on."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        keep_only()
        for batch in batches:
            p = [model.probability(shape_features(part)) for part in slices(batch.column("text").to_pylist())]
            yield pa.RecordBatch.from_arrays([*(batch.column(c) for c in names[:3]), pa.array(np.concatenate([np.empty(0), *p])), *(batch.column(c) for c in order)], names)

    carried = [f"x_{k}" for k in range(len(carry or []))]
    # The text crosses to Python once, also where it is carried.
    order = ["text" if c == "text" else x for c, x in zip(carry or [], carried, strict=True)]
    names = ["doc_id", "host", "path", "p_document", *carried]
    path = F.concat_ws("/", F.coalesce("source", F.lit("")), F.coalesce("lang", F.lit("")))
    rows = docs.select(F.col("text").cast("string").alias("text"), F.col("doc_id").cast("long").alias("doc_id"), F.coalesce("source", F.lit("")).alias("host"), path.alias("path"), *(F.col(c).alias(x) for c, x in zip(carry or [], carried, strict=True) if c != "text"))
    types = {f.name: f.dataType.simpleString() for f in rows.schema}
    return rows.mapInArrow(run, "doc_id long, host string, path string, p_document double" + "".join(f", {x} {types[c]}" for x, c in zip(carried, order, strict=True)))


def _strength(sites: DataFrame, parent: str) -> float:
    """Documents that the parent counts for: within-site variance over the variance of sites beyond it."""
    within = F.col("square") - F.col("n") * F.col("mean") * F.col("mean")
    row = sites.agg(
        F.sum(within).alias("w"), F.sum(F.col("n") - 1).alias("df"), F.count("*").alias("s"), F.sum("n").alias("n"), F.sum(F.col("n") * F.col("n")).alias("nn"),
        F.sum(F.col("n") * (F.col("mean") - F.col(parent)) * (F.col("mean") - F.col(parent))).alias("b"),
    ).first()
    if not row["n"] or row["s"] < 2 or not row["df"]:
        return 10.0
    within_variance = max(row["w"], 0.0) / row["df"]
    spread = row["n"] - row["nn"] / row["n"]
    between = (row["b"] - (row["s"] - 1) * within_variance) / spread if spread > 0 else 0.0
    return float(np.clip(within_variance / between, 1.0, 1e6)) if between > 1e-9 else 1e6


def site_posteriors(scored: DataFrame) -> tuple[DataFrame, float]:
    """(host, path, p_host, p_path) and the mean of all documents."""
    sums = [F.count("*").alias("n"), F.sum("p_document").alias("total"), F.sum(F.col("p_document") * F.col("p_document")).alias("square")]
    paths = stored(scored.groupBy("host", "path").agg(*sums), "paths")
    hosts = paths.groupBy("host").agg(F.sum("n").alias("n"), F.sum("total").alias("total"), F.sum("square").alias("square")).withColumn("mean", F.col("total") / F.col("n"))
    whole = hosts.agg(F.sum("total") / F.sum("n")).first()[0]
    whole = 0.5 if whole is None else float(whole)
    k = _strength(hosts.withColumn("parent", F.lit(whole)), "parent")
    hosts = hosts.select("host", ((F.col("total") + k * whole) / (F.col("n") + k)).alias("p_host"))
    below = paths.withColumn("mean", F.col("total") / F.col("n")).join(hosts, "host")
    k = _strength(below, "p_host")
    return below.select("host", "path", "p_host", ((F.col("total") + k * F.col("p_host")) / (F.col("n") + k)).alias("p_path")), whole


def _logit(p):
    held = F.least(F.greatest(p, F.lit(1e-6)), F.lit(1 - 1e-6))
    return F.log(held / (1 - held))


#: Sites up to which their posteriors are broadcast (about 100 bytes each); beyond it documents are shuffled by site.
BROADCAST_SITES = 50_000


def _with_posterior(scored: DataFrame, sites: DataFrame, whole: float) -> DataFrame:
    shift = F.least(F.greatest(_logit(F.col("p_path")) - float(np.log(max(whole, 1e-6) / max(1 - whole, 1e-6))), F.lit(-MOST_SHIFT)), F.lit(MOST_SHIFT))
    p = 1 / (1 + F.exp(-(_logit(F.col("p_document")) + shift)))
    sites = stored(sites, "sites")
    if sites.count() <= BROADCAST_SITES:
        sites = F.broadcast(sites)
    out = scored.join(sites, ["host", "path"]).withColumn("p", F.when(F.col("p_document") > 0, p).otherwise(F.lit(0.0)))
    return out.withColumn("keep", F.col("p") >= KEEP)


def judge(docs: DataFrame, labels: DataFrame) -> DataFrame:
    """(doc_id, host, path, p_document, p_host, p_path, p, keep)."""
    scored = stored(evidence(docs, train(docs, labels)), "evidence")
    return _with_posterior(scored, *site_posteriors(scored)).select("doc_id", "host", "path", "p_document", "p_host", "p_path", "p", "keep")


def kept_documents(docs: DataFrame, labels: DataFrame) -> DataFrame:
    """The rows of docs that are kept, with their columns. Texts are scored once for the sites and once for the decision, so that they are never shuffled while the sites can be broadcast."""
    model = train(docs, labels)
    sites, whole = site_posteriors(stored(evidence(docs, model), "evidence"))
    scored = _with_posterior(evidence(docs, model, carry=docs.columns), sites, whole)
    return scored.where("keep").select(*(F.col(f"x_{k}").alias(c) for k, c in enumerate(docs.columns)))


def op5_quality_bayes(spark: SparkSession, sf_dir: str) -> DataFrame:
    return judge(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))
