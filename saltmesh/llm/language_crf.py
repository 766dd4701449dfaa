"""Word-level language labels by a linear-chain conditional random field, and languages of documents from them.

A word's features are prefixes and suffixes of one to three letters, letter pairs and triples, and its entry in a
lexicon of frequent training words. Transitions between the labels of neighbouring words are learned with the feature
weights, on word sequences put together from documents of one language or, code-switched, of several. Labels of a text
are the posteriors of forward-backward over all its words: texts are cut into segments, each segment's transfer matrix
is computed beside the others, messages pass from segment to segment, and then all segments run at once; this equals
the pass over the whole text.

A document's language is the label with the largest mean posterior, its score that mean.

The model is fitted on at most TRAIN_DOCS documents of each language, drawn by a hash of their ids from the documents
that are not held out. Every document is labelled whole.

Defined results: null text, or text without a letter, is `und` with score 0. Without training documents everything is
`und`. Repeated rows are labelled each on their own. Extra columns are ignored; an empty table gives an empty result.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from .bytehash import Prefix, mix
from .shared import keep_only, slices, table

TRAIN_DOCS, TRAIN_WORDS = 250, 400
#: Slots of a language in the draw of its training documents: of each, at most TRAIN_DOCS go on.
DRAW_SLOTS = 64
SEQUENCES, SEQUENCE_WORDS, EPOCHS, BATCH = 2_400, 48, 6, 200
BUCKETS = 1 << 16
SEGMENT = 128
UNDETERMINED = "und"
#: A document below this score is rejected by `accepted`; texts of a few words may well be under a half.
LEAST_SCORE = 0.35

_tables: list[np.ndarray] = []


def _letters() -> tuple[np.ndarray, np.ndarray]:
    """For each character whether it is a letter, and its lower case if that is one character."""
    if not _tables:
        chars = [chr(c) if not 0xD800 <= c < 0xE000 else " " for c in range(0x110000)]
        _tables.append(np.array([c.isalpha() for c in chars]))
        _tables.append(np.array([ord(c.lower()) if len(c.lower()) == 1 else ord(c) for c in chars], np.uint32))
    return _tables[0], _tables[1]


@dataclass
class Words:
    """Words of several texts: their letters one after another, bounds, hashes, and the number of words of each text."""

    letters: np.ndarray
    start: np.ndarray
    end: np.ndarray
    hashes: np.ndarray
    per_text: np.ndarray


def words_of(texts: list[str]) -> Words:
    is_letter, lower = _letters()
    chars = np.frombuffer("\n".join([*texts, ""]).encode("utf-32-le"), np.uint32)
    word = is_letter[chars]
    edge = np.diff(np.r_[False, word, False].astype(np.int8))
    start, end = np.flatnonzero(edge == 1), np.flatnonzero(edge == -1)
    low = lower[chars]
    bounds = np.cumsum([0, *(len(t) + 1 for t in texts)])
    hashes = Prefix(low).hash(start, end) if len(start) else np.empty(0, np.uint64)
    return Words(low, start, end, hashes, np.diff(np.searchsorted(start, bounds)))


def features(letters: np.ndarray, start: np.ndarray, end: np.ndarray, hashes: np.ndarray, lexicon: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Feature numbers and the word of each, sorted by word."""
    size = (end - start).astype(np.int64)
    word = np.repeat(np.arange(len(size)), size)
    at = np.arange(size.sum()) - np.repeat(np.cumsum(size) - size, size)
    place = start[word] + at
    c = letters[place].astype(np.uint64)
    after = at + 1 < size[word]
    after2 = at + 2 < size[word]
    limit = len(letters) - 1
    c1 = np.where(after, letters[np.minimum(place + 1, limit)], 3).astype(np.uint64)
    c2 = np.where(after2, letters[np.minimum(place + 2, limit)], 3).astype(np.uint64)
    pair = c << np.uint64(21) | c1
    numbers = [mix(pair + np.uint64(1 << 62)), mix(pair * np.uint64(1 << 20) + c2 * np.uint64(7919) + np.uint64(2))]
    owners = [word, word]
    for n in (1, 2, 3):
        long = np.flatnonzero(size >= n)
        head = np.full(len(long), n, np.uint64)
        tail = np.full(len(long), n + 16, np.uint64)
        for k in range(n):
            head = mix(head + letters[start[long] + k])
            tail = mix(tail + letters[end[long] - 1 - k])
        numbers += [head, tail]
        owners += [long, long]
    bucket = (np.concatenate(numbers) >> np.uint64(40)).astype(np.int64) % BUCKETS
    entry = np.searchsorted(lexicon, hashes)
    known = np.flatnonzero(entry < len(lexicon))
    known = known[lexicon[entry[known]] == hashes[known]]
    bucket = np.r_[bucket, BUCKETS + entry[known]]
    owner = np.concatenate([*owners, known])
    order = np.argsort(owner, kind="stable")
    return bucket[order], owner[order]


def emissions(w: Words, lexicon: np.ndarray, weights: np.ndarray) -> np.ndarray:
    """Score of each label for each word; equal words are scored once."""
    _, first, back = np.unique(w.hashes, return_index=True, return_inverse=True)
    number, owner = features(w.letters, w.start[first], w.end[first], w.hashes[first], lexicon)
    head = np.flatnonzero(np.r_[True, owner[1:] != owner[:-1]])
    return np.add.reduceat(weights[number], head, axis=0)[back]


@dataclass
class LanguageCrf:
    labels: list[str]
    lexicon: np.ndarray
    weights: np.ndarray
    transitions: np.ndarray

    def posteriors(self, score: np.ndarray, per_text: np.ndarray, segment: int = SEGMENT) -> np.ndarray:
        """Posterior of each label for each word, by forward-backward over each text."""
        n_labels = len(self.labels)
        step = np.exp(self.transitions - self.transitions.max())
        local = np.exp(score - score.max(axis=1, keepdims=True))
        pieces = -(-per_text // segment)
        text = np.repeat(np.arange(len(per_text)), pieces)
        k = np.arange(len(text)) - np.repeat(np.cumsum(pieces) - pieces, pieces)
        first = np.repeat(np.cumsum(per_text) - per_text, pieces) + k * segment
        size = np.minimum(segment, np.repeat(per_text, pieces) - k * segment)
        # Shorter segments are filled with steps that change nothing.
        place = first[:, None] + np.arange(segment)
        real = np.arange(segment) < size[:, None]
        e = np.where(real[:, :, None], local[np.minimum(place, len(local) - 1)], 1.0).astype(np.float64)

        transfer = np.broadcast_to(np.eye(n_labels), (len(text), n_labels, n_labels)).copy()
        for t in range(segment):
            on = np.flatnonzero(real[:, t])
            if not len(on):
                break
            moved = transfer[on] @ step if t else np.where((k[on] == 0)[:, None, None], transfer[on], transfer[on] @ step)
            new = moved * e[on, t, None, :]
            transfer[on] = new / new.sum(axis=(1, 2), keepdims=True)
        flat = np.ones(n_labels)
        before = np.tile(flat, (len(text), 1))
        behind = np.tile(flat, (len(text), 1))
        for j in range(1, int(pieces.max(initial=0))):
            on = np.flatnonzero(k == j)
            new = np.einsum("sa,sab->sb", before[on - 1], transfer[on - 1])
            before[on] = new / new.sum(axis=1, keepdims=True)
        left = np.repeat(pieces, pieces) - 1 - k
        for j in range(1, int(pieces.max(initial=0))):
            on = np.flatnonzero(left == j)
            new = np.einsum("sab,sb->sa", transfer[on + 1], behind[on + 1])
            behind[on] = new / new.sum(axis=1, keepdims=True)
        forward = np.empty_like(e)
        message = before
        for t in range(segment):
            # The first word of a text has no word before it.
            moved = message @ step if t else np.where((k == 0)[:, None], message, message @ step)
            new = moved * e[:, t]
            new /= new.sum(axis=1, keepdims=True)
            message = np.where(real[:, t, None], new, message)
            forward[:, t] = message
        backward = np.empty_like(e)
        message = behind
        for t in range(segment - 1, -1, -1):
            backward[:, t] = message
            new = (message * e[:, t]) @ step.T
            new /= new.sum(axis=1, keepdims=True)
            message = np.where(real[:, t, None], new, message)
        both = forward * backward
        both /= both.sum(axis=2, keepdims=True)
        return both[real]

    def label_words(self, texts: list[str]) -> Iterator[np.ndarray]:
        """For each text, the posteriors of its words."""
        w = words_of(texts)
        p = self.posteriors(emissions(w, self.lexicon, self.weights), w.per_text) if len(w.start) else np.empty((0, len(self.labels)))
        yield from np.split(p, np.cumsum(w.per_text)[:-1])

    def predict(self, texts: list[str]) -> list[tuple[str, float, int]]:
        """Language, score and number of label changes of each text."""
        out = []
        if not self.labels:
            return [(UNDETERMINED, 0.0, 0)] * len(texts)
        for p in self.label_words(texts):
            if not len(p):
                out.append((UNDETERMINED, 0.0, 0))
                continue
            mean = p.mean(axis=0)
            best = p.argmax(axis=1)
            out.append((self.labels[int(mean.argmax())], float(min(1.0, mean.max())), int((best[1:] != best[:-1]).sum())))
        return out


def fit(texts: list[str], langs: list[str], seed: int = 5) -> LanguageCrf:
    """Weights and transitions by AdaGrad on the log-likelihood of whole sequences."""
    labels = sorted(set(langs))
    w = words_of(texts)
    if len(labels) < 1 or not len(w.start):
        return LanguageCrf([], np.empty(0, np.uint64), np.zeros((BUCKETS, 1), np.float32), np.zeros((1, 1)))
    text = np.repeat(np.arange(len(texts)), w.per_text)
    truth = np.array([labels.index(x) for x in langs])[text]
    values, counts = np.unique(w.hashes, return_counts=True)
    lexicon = values[counts >= 3]
    _, some, same = np.unique(w.hashes, return_index=True, return_inverse=True)
    number, owner = features(w.letters, w.start[some], w.end[some], w.hashes[some], lexicon)
    first = np.searchsorted(owner, np.arange(len(some) + 1))
    rng = np.random.default_rng(seed)
    ends = np.cumsum(w.per_text)
    usable = np.flatnonzero(w.per_text > 0)
    chains = np.empty((SEQUENCES, SEQUENCE_WORDS), np.int64)
    for s in range(SEQUENCES):
        # A third of the sequences is of one text, the others change texts, and mostly languages, once or twice.
        cuts = np.sort(rng.choice(np.arange(4, SEQUENCE_WORDS - 4), s % 3, replace=False))
        parts = []
        for size in np.diff(np.r_[0, cuts, SEQUENCE_WORDS]):
            d = rng.choice(usable)
            at = ends[d] - w.per_text[d] + rng.integers(0, max(1, w.per_text[d] - size + 1))
            parts.append(np.minimum(at + np.arange(size), ends[d] - 1))
        chains[s] = np.concatenate(parts)
    n = len(labels)
    weights, square = np.zeros((BUCKETS + len(lexicon), n)), np.full((BUCKETS + len(lexicon), n), 1e-4)
    moves, square_moves = np.zeros((n, n)), np.full((n, n), 1e-4)
    model = LanguageCrf(labels, lexicon, weights, moves)
    for epoch in range(EPOCHS):
        for at in np.array_split(rng.permutation(SEQUENCES), SEQUENCES // BATCH):
            gold = truth[chains[at].ravel()]
            words = same[chains[at].ravel()]
            count = first[words + 1] - first[words]
            row = np.repeat(np.arange(len(words)), count)
            feats = number[np.repeat(first[words] - np.r_[0, np.cumsum(count)[:-1]], count) + np.arange(count.sum())]
            score = np.zeros((len(words), n))
            for k in range(n):
                score[:, k] = np.bincount(row, weights[feats, k], len(words))
            p, pairs = model._expected(score.reshape(len(at), SEQUENCE_WORDS, n))
            p = p.reshape(-1, n)
            p[np.arange(len(words)), gold] -= 1
            grad = np.zeros_like(weights)
            for k in range(n):
                grad[:, k] = np.bincount(feats, p[row, k], len(weights)) / len(at) + 1e-6 * weights[:, k]
            gold = gold.reshape(len(at), SEQUENCE_WORDS)
            seen = np.zeros((n, n))
            np.add.at(seen, (gold[:, :-1].ravel(), gold[:, 1:].ravel()), 1)
            move = (pairs - seen) / len(at) + 1e-3 * moves
            square += grad * grad
            square_moves += move * move
            weights -= 0.2 * grad / np.sqrt(square)
            moves -= 0.1 * move / np.sqrt(square_moves)
    model.weights = weights.astype(np.float32)
    return model


def _expected(self: LanguageCrf, score: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Posteriors of labels, and expected numbers of label pairs, of sequences of equal length."""
    s, t, n = score.shape
    step = np.exp(self.transitions)
    e = np.exp(score - score.max(axis=2, keepdims=True))
    forward, backward = np.empty_like(e), np.ones_like(e)
    m = e[:, 0]
    forward[:, 0] = m / m.sum(axis=1, keepdims=True)
    for k in range(1, t):
        m = (forward[:, k - 1] @ step) * e[:, k]
        forward[:, k] = m / m.sum(axis=1, keepdims=True)
    for k in range(t - 2, -1, -1):
        m = (backward[:, k + 1] * e[:, k + 1]) @ step.T
        backward[:, k] = m / m.sum(axis=1, keepdims=True)
    both = forward * backward
    both /= both.sum(axis=2, keepdims=True)
    pairs = forward[:, :-1, :, None] * step * (e[:, 1:] * backward[:, 1:])[:, :, None, :]
    pairs /= pairs.sum(axis=(2, 3), keepdims=True)
    return both, pairs.sum(axis=(0, 1))


LanguageCrf._expected = _expected


def held_out(id_col: str = "doc_id") -> Column:
    return F.coalesce(F.crc32(F.col(id_col).cast("string").cast("binary")) % 4 == 2, F.lit(False))


def train(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", lang_col: str = "lang") -> LanguageCrf:
    """Fitted on at most TRAIN_DOCS documents of each language, and on at most TRAIN_WORDS words from a drawn place of each. Rows of equal id, text and language are one document, so ids may repeat without limit.

    The draw takes the first of each slot of a language before it takes the first of the language: no task orders a whole language."""
    rows = docs.where(~held_out(id_col) & F.col(lang_col).isNotNull() & F.col(text_col).isNotNull() & F.col(id_col).isNotNull())
    rows = rows.select(F.col(id_col).cast("long").alias("id"), F.col(text_col).cast("string").alias("text"), F.col(lang_col).cast("string").alias("lang"))
    rows = rows.withColumn("h", F.xxhash64("text"))
    drawn = rows.groupBy("id", "h", "lang").agg(F.pmod(F.xxhash64("id", "h"), F.lit(DRAW_SLOTS)).alias("slot"))
    for keys in (["lang", "slot"], ["lang"]):
        order = Window.partitionBy(*keys).orderBy(F.xxhash64("id"), "id", "h")
        drawn = drawn.withColumn("n", F.row_number().over(order)).where(F.col("n") <= TRAIN_DOCS)
    sample = rows.join(F.broadcast(drawn.select("id", "h", "lang")), ["id", "h", "lang"])
    words = F.split("text", r"\s+")
    at = (F.pmod(F.xxhash64("id"), F.greatest(F.size(words) - TRAIN_WORDS, F.lit(0)) + 1) + 1).cast("int")
    sample = sample.select("id", "h", "lang", F.concat_ws(" ", F.slice(words, at, TRAIN_WORDS)).alias("text")).groupBy("id", "h", "lang").agg(F.min("text").alias("text"))
    sample = sample.toPandas().sort_values(["id", "lang", "text"])
    return fit(sample["text"].tolist(), sample["lang"].tolist())


def label_documents(docs: DataFrame, model: LanguageCrf, id_col: str = "doc_id", text_col: str = "text", keep: list[str] | None = None) -> DataFrame:
    """(doc_id, lang_pred, score, switches) and the columns named in keep; switches counts label changes between neighbouring words."""
    carried = [f"x_{k}" for k in range(len(keep or []))]
    rows = docs.select(F.col(id_col).cast("long").alias("_id"), F.col(text_col).cast("string").alias("_text"), *(F.col(c).alias(x) for c, x in zip(keep or [], carried, strict=True) if c != text_col))
    # The text crosses to Python once, also where it is to be kept.
    order = ["_text" if c == text_col else x for c, x in zip(keep or [], carried, strict=True)]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        keep_only()
        for batch in batches:
            found = [x for part in slices(batch.column("_text").to_pylist()) for x in model.predict(part)]
            cols = list(zip(*found, strict=True)) or [()] * 3
            yield pa.RecordBatch.from_arrays([batch.column("_id"), pa.array(cols[0], pa.string()), pa.array(cols[1], pa.float64()), pa.array(cols[2], pa.int64()), *(batch.column(c) for c in order)], names)

    names = ["doc_id", "lang_pred", "score", "switches", *carried]
    types = {f.name: f.dataType.simpleString() for f in rows.schema}
    schema = "doc_id long, lang_pred string, score double, switches long" + "".join(f", {x} {types[c]}" for x, c in zip(carried, order, strict=True))
    return rows.mapInArrow(run, schema)


def accepted() -> Column:
    return (F.col("lang_pred") != UNDETERMINED) & (F.col("score") >= LEAST_SCORE)


def kept_documents(docs: DataFrame) -> DataFrame:
    """The rows of docs whose language is accepted, with their columns."""
    found = label_documents(docs, train(docs), keep=docs.columns).where(accepted())
    return found.select(*(F.col(f"x_{k}").alias(c) for k, c in enumerate(docs.columns)))


def op2_language_crf(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    found = label_documents(docs, train(docs))
    return found.select("doc_id", held_out().alias("held_out"), "lang_pred", "score", "switches")
