"""Near duplicates by an exact Jaccard join of word n-grams over a token-group matrix.

A document is the set of its distinct n-word shingles (64-bit hashes). Equal sets are one node. In any order of the
tokens that all sets share, the first tokens that two linked sets have in common stand among the first tokens of both:
the first `few` of them within `head` places. So each set's head in the order of the hashes is its row of keys, and a
set that shares fewer than `least` keys with others links to nothing. What is left is exact: no link is lost.

Sets with enough shared keys are partitioned into groups of similar documents: each joins the leader that most of its keys
have, and groups are cut into blocks of bounded size, in documents and in tokens. For each block its token union is kept, with who has which token: a
query with too few tokens in the union can't link to any member, and the block stays shut; open blocks are compared by
exact intersection sizes.

Blocks are compared within themselves first; then one document of each component crosses to the block of a leader of
its keys (bridges). Left are documents that still share enough keys with other components. All their tokens are counted, and a
document opens the blocks in whose column of the matrix one of its rarest tokens stands (rarest among those documents): of
two linked documents, as many of the rarest as their size leaves room to differ, and one, must have one in common. A
passage that many documents share thus brings no visits. Components are taken after each step, so a group of thousands of
near copies costs its size and not the square of it.

Defined results: null or empty text, or one without words, has n_shingles 0 and its own id as component. Fewer than n
words are one shingle. Rows that repeat an id are rows of their own: they have one component only if their texts link. Extra
columns are ignored, whatever their names; rows without an id link to nothing; an empty table gives an empty result.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from .bytehash import Prefix, mix
from .components import components
from .shared import drop_tables, free_shuffles, fresh, keep_only, last_made, slices, stored, table, tables_made

WORDS, PERCENT = 5, 80
#: Documents of a block, and visitors that are compared with it at once.
BLOCK = 128
#: Tokens of a block, and of the visitors compared with it at once (eight bytes each): as many sets of very long texts would not fit a task.
BLOCK_TOKENS = 1 << 20
#: Rows of ids and numbers up to which they are broadcast to the documents (40 bytes each); beyond it the documents are shuffled.
BROADCAST_ROWS = 200_000

LOWER = bytes(c + 32 if 65 <= c <= 90 else 32 if 9 <= c <= 13 else c for c in range(256))


def shingle_sets(texts: list[str], n: int = WORDS) -> Iterator[np.ndarray]:
    """For each text its distinct shingle hashes in order."""
    raw = [t.encode().translate(LOWER) for t in texts]
    data = np.frombuffer(b" ".join([*raw, b" "]), np.uint8)
    word = data != 32
    edge = np.diff(np.r_[False, word, False].astype(np.int8))
    start, end = np.flatnonzero(edge == 1), np.flatnonzero(edge == -1)
    hashes = Prefix(data).hash(start, end) if len(start) else np.empty(0, np.uint64)
    bounds = np.cumsum([0, *(len(r) + 1 for r in raw)])
    first = np.searchsorted(start, bounds)
    for k in range(len(raw)):
        w = hashes[first[k] : first[k + 1]]
        if len(w) > n:
            size = len(w) - n + 1
            s = np.zeros(size, np.uint64)
            for i in range(n):
                s = mix(s + w[i : i + size])
            s.sort()
            yield s[np.r_[True, s[1:] != s[:-1]]]
        elif len(w):
            s = np.zeros(1, np.uint64)
            for i in range(len(w)):
                s = mix(s + w[i])
            yield s
        else:
            yield np.empty(0, np.uint64)


def need(n, percent: int):
    """Tokens of n that a partner has to share at the least: of the union, so of each side. For numbers and columns."""
    return F.ceil(n * percent / 100) if isinstance(n, Column) else -(-n * percent // 100)


def few(n, percent: int):
    """How many of the first common tokens the head of a set of n tokens surely holds."""
    if isinstance(n, Column):
        return F.least(need(n, percent), F.floor((n - need(n, percent)) / 2) + 1)
    return min(need(n, percent), (n - need(n, percent)) // 2 + 1)


def head(n: int, percent: int) -> int:
    """Places among which the first `few` common tokens stand: a set may lack n - need of its tokens before them."""
    return n - need(n, percent) + few(n, percent)


def least(n: Column, percent: int) -> Column:
    """Keys that a set of n tokens shares with any partner; partners may be as small as need(n)."""
    return few(need(n, percent), percent)


def signatures(docs: DataFrame, n: int = WORDS, percent: int = PERCENT) -> DataFrame:
    """docs (doc_id, text) to (doc_id, text_key, n_shingles, set_a, set_b, keys): set_a and set_b name the set, keys are the least of its hashes, text_key tells rows of one id apart."""

    def sign(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        keep_only()
        for batch in batches:
            size, a, b, keys = [], [], [], []
            for part in slices(batch.column(2).to_pylist()):
                for s in shingle_sets(part, n):
                    size.append(len(s))
                    a.append(np.int64(mix(s).sum(dtype=np.uint64).astype(np.int64)))
                    b.append(np.int64(mix(s + np.uint64(77)).sum(dtype=np.uint64).astype(np.int64)))
                    keys.append(s[: head(len(s), percent)].astype(np.int64) if len(s) else np.empty(0, np.int64))
            offsets = np.cumsum([0, *map(len, keys)]).astype(np.int32)
            lists = pa.ListArray.from_arrays(pa.array(offsets), pa.array(np.concatenate([np.empty(0, np.int64), *keys])))
            yield pa.RecordBatch.from_arrays([batch.column(0), batch.column(1), pa.array(size, pa.int64()), pa.array(a, pa.int64()), pa.array(b, pa.int64()), lists], ["doc_id", "text_key", "n_shingles", "set_a", "set_b", "keys"])

    rows = docs.select("doc_id", F.xxhash64("text").alias("text_key"), "text")
    return rows.mapInArrow(sign, "doc_id long, text_key long, n_shingles long, set_a long, set_b long, keys array<long>")


def token_sets(docs: DataFrame, n: int = WORDS) -> DataFrame:
    """(node, block, text) to (node, block, tokens)."""

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            sets = [np.sort(s.astype(np.int64)) for part in slices(batch.column(2).to_pylist()) for s in shingle_sets(part, n)]
            offsets = np.cumsum([0, *map(len, sets)]).astype(np.int32)
            lists = pa.ListArray.from_arrays(pa.array(offsets), pa.array(np.concatenate([np.empty(0, np.int64), *sets])))
            yield pa.RecordBatch.from_arrays([batch.column(0), batch.column(1), lists], ["node", "block", "tokens"])

    return docs.select("node", "block", "text").mapInArrow(cut, "node long, block long, tokens array<long>")


class TokenBlock:
    """A row of the token-group matrix: the members of a block, and the union of their tokens with who has which."""

    def __init__(self, sets: list[np.ndarray], percent: int):
        self.percent = percent
        self.sizes = np.array([len(s) for s in sets], np.int64)
        tokens = np.concatenate(sets) if sets else np.empty(0, np.int64)
        order = np.argsort(tokens, kind="stable")
        self.owner = np.repeat(np.arange(len(sets)), self.sizes)[order]
        tokens = tokens[order]
        head = np.flatnonzero(np.r_[True, tokens[1:] != tokens[:-1]]) if len(tokens) else np.empty(0, np.int64)
        self.union, self.begin = tokens[head], np.r_[head, len(tokens)]

    def linked(self, query: np.ndarray) -> np.ndarray:
        """Members that link with the query. The bound: a partner shares percent of the query's tokens at least, all of them in the union."""
        at = np.searchsorted(self.union, query)
        at = at[at < len(self.union)] if len(self.union) else at[:0]
        hit = at[self.union[at] == query[: len(at)]] if len(at) else at
        if 100 * len(hit) < self.percent * len(query) or not len(hit):
            return np.empty(0, np.int64)
        count = self.begin[hit + 1] - self.begin[hit]
        place = np.repeat(self.begin[hit] - np.r_[0, np.cumsum(count)[:-1]], count) + np.arange(count.sum())
        shared = np.bincount(self.owner[place], minlength=len(self.sizes))
        return np.flatnonzero(100 * shared >= self.percent * (self.sizes + len(query) - shared))


def _groups(batches: Iterator[pa.RecordBatch]) -> Iterator[list[tuple]]:
    """Rows (block, slot, kind, node, component, tokens), which come sorted, of one block and slot at a time."""
    held: list[tuple] = []
    for batch in batches:
        lists = batch.column(5)
        values, offsets = lists.values.to_numpy(zero_copy_only=False), lists.offsets.to_numpy()
        cols = [batch.column(k).to_pylist() for k in range(5)]
        for k, row in enumerate(zip(*cols, strict=True)):
            if held and held[0][:2] != row[:2]:
                yield held
                held = []
            held.append((*row, values[offsets[k] : offsets[k + 1]].copy()))
    if held:
        yield held


def _find(root: list[int], k: int) -> int:
    while root[k] != k:
        root[k] = root[root[k]]
        k = root[k]
    return k


def compare(rows: DataFrame, percent: int, within: bool) -> DataFrame:
    """Links (a, b) of members (kind 0) with each other, or of visitors (kind 1) with members of other components."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for rows in _groups(batches):
            members = [r for r in rows if r[2] == 0]
            visitors = members if within else [r for r in rows if r[2] == 1]
            if not members or not visitors or (within and len(members) < 2):
                continue
            block = TokenBlock([r[5] for r in members], percent)
            roots = {r[4]: None for r in rows}
            number = {c: k for k, c in enumerate(roots)}
            root = list(range(len(number)))
            links: list[tuple[int, int]] = []
            own = [number[r[4]] for r in members]
            for q in visitors:
                mine = number[q[4]]
                if within and links and all(_find(root, k) == _find(root, mine) for k in set(own)):
                    break
                for m in block.linked(q[5]).tolist():
                    a, b = _find(root, mine), _find(root, own[m])
                    if a != b:
                        root[a] = b
                        links.append((q[3], members[m][3]))
            if links:
                a, b = zip(*links, strict=True)
                yield pa.RecordBatch.from_pydict({"a": pa.array(a, pa.int64()), "b": pa.array(b, pa.int64())})

    placed = rows.repartition(_tasks(rows.sparkSession), "block", "slot").sortWithinPartitions("block", "slot", "kind")
    return placed.select("block", "slot", "kind", "node", "component", "tokens").mapInArrow(run, "a long, b long")


def _tasks(spark: SparkSession) -> int:
    return int(spark.conf.get("spark.sql.shuffle.partitions"))


def _shares(what: str) -> Column:
    """Into how many shares of at most about BLOCK sets and BLOCK_TOKENS tokens the sets of a group, each of n tokens, are dealt."""
    return F.greatest(F.ceil(F.count("*") / F.lit(BLOCK)), F.ceil(F.sum("n") / F.lit(BLOCK_TOKENS))).cast("int").alias(what)


def _labelled(nodes: DataFrame, labels: DataFrame | None) -> DataFrame:
    """nodes with their component from labels, else themselves."""
    if labels is None:
        return nodes.withColumn("component", F.col("node"))
    return nodes.join(labels.withColumnRenamed("id", "node"), "node", "left").withColumn("component", F.coalesce("component", "node"))


def _opened_by_rare_tokens(docs: DataFrame, tokens: DataFrame, percent: int) -> DataFrame:
    """(node, component, block) for docs (node, block, component): the blocks that each document opens, once for each pair, from the smaller component to the larger."""
    docs = stored(docs, "unsettled")
    size = docs.groupBy("component").agg(F.count("*").alias("members"))
    docs = stored(docs.join(size, "component").select("node", "block", F.struct("members", "component").alias("own")), "unsettled")
    held = tokens.select("node", "tokens").join(docs.select("node"), "node")
    entries = held.select("node", F.size("tokens").alias("n"), F.explode("tokens").alias("token"))
    often = entries.groupBy("token").agg(F.count("*").alias("df")).where("df > 1")
    shared = entries.join(often, "token").groupBy("node", "n").agg(F.array_sort(F.collect_list(F.struct("df", "token"))).alias("list"))
    # Tokens of one document alone come first in the order and need no rows.
    length = F.col("n") - need(F.col("n"), percent) + 1 - (F.col("n") - F.size("list"))
    first = F.slice("list", F.lit(1), F.greatest(length, F.lit(0)).cast("int"))
    rare = shared.select("node", F.explode(first).alias("t")).select("node", "t.token").join(docs, "node")
    rare = stored(rare, "rare-tokens")
    free_shuffles(docs.sparkSession)
    columns = rare.groupBy("token", "block").agg(F.max("own").alias("top"))
    met = rare.withColumnRenamed("block", "_from").join(columns, "token").where("block <> _from and top > own")
    return met.select("node", F.col("own.component").alias("component"), "block").distinct()


def _nodes(signed: DataFrame) -> DataFrame:
    """(node, rep, text_key, set_a, set_b, n_shingles, keys) of each set: rep is its smallest doc_id. The node is that id too, or a number of its own where an id stands for several texts that are each the first of their sets."""
    named = signed.where("n_shingles > 0 and doc_id is not null")
    sets = named.groupBy("set_a", "set_b", "n_shingles").agg(F.min(F.struct("doc_id", "text_key")).alias("least"), F.first("keys").alias("keys"))
    sets = stored(sets.select("set_a", "set_b", "n_shingles", F.col("least.doc_id").alias("rep"), "least.text_key", "keys"), "sets")
    several = stored(sets.groupBy("rep").agg(F.count("*").alias("k")).where("k > 1").select("rep", F.lit(True).alias("several")), "repeated-ids")
    if several.isEmpty():
        return sets.withColumn("node", F.col("rep"))
    return sets.join(several, "rep", "left").withColumn("node", F.when(F.col("several"), F.xxhash64("rep", "set_a", "set_b")).otherwise(F.col("rep"))).drop("several")


def near_duplicates(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", n: int = WORDS, percent: int = PERCENT) -> DataFrame:
    """(doc_id, text_key, n_shingles, component_id): component_id is the smallest doc_id that links reach, text_key the xxhash64 of the text."""
    spark = docs.sparkSession
    docs = docs.select(F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).cast("string").alias("text"))
    since = tables_made()
    signed = stored(signatures(docs, n, percent), "signed")
    needed = [last_made()]
    nodes = stored(_nodes(signed), "nodes")
    needed.append(last_made())
    drop_tables(spark, since, needed)
    free_shuffles(spark)
    entries = nodes.select("node", F.explode("keys").alias("key"))
    shared_keys = entries.groupBy("key").agg(F.count("*").alias("c")).where("c > 1")
    entries = stored(entries.join(shared_keys, "key"), "entries")
    free_shuffles(spark)
    sizes = nodes.select("node", F.col("n_shingles").alias("n"))
    ready = entries.groupBy("node").agg(F.count("*").alias("shared"), F.sum("c").alias("w")).join(sizes, "node").where(F.col("shared") >= least(F.col("n"), percent))
    entries = stored(entries.select("node", "key").join(ready.select("node", "n", "w"), "node"), "ready")
    needed.append(last_made())
    drop_tables(spark, since, needed)
    free_shuffles(spark)

    # Groups: the leader of a key is the document that shares most keys with others; a document joins its most frequent leader.
    leaders = entries.groupBy("key").agg(F.max_by("node", F.struct("w", -F.col("node"))).alias("leader"), F.count("*").alias("c")).where("c > 1").drop("c")
    votes = stored(entries.select("node", "n", "key").join(leaders, "key").groupBy("node", "n", "leader").agg(F.count("*").alias("v")), "votes")
    group = votes.groupBy("node", "n").agg(F.max_by("leader", F.struct("v", -F.col("leader"))).alias("grp"))
    group = stored(group, "groups")
    parts = group.groupBy("grp").agg(_shares("parts"))
    blocks = stored(group.join(parts, "grp").select("node", "n", F.xxhash64("grp", F.pmod(F.xxhash64("node"), "parts")).alias("block")), "blocks")
    free_shuffles(spark)
    wanted = blocks.join(nodes.select("node", "rep", "text_key"), "node")
    if blocks.count() <= BROADCAST_ROWS:
        wanted = F.broadcast(wanted)
    chosen = docs.select(F.col("doc_id").alias("rep"), F.xxhash64("text").alias("text_key"), "text").join(wanted, ["rep", "text_key"])
    # Rows that repeat an id and a text are one.
    chosen = chosen.groupBy("node", "block").agg(F.first("text").alias("text"))
    tokens = stored(token_sets(chosen, n), "tokens")
    free_shuffles(spark)

    own = _labelled(tokens, None).select("block", F.lit(0).alias("slot"), F.lit(0).alias("kind"), "node", "component", "tokens")
    links = stored(compare(own, percent, within=True), "within")
    free_shuffles(spark)

    for step in ("bridges", "rest"):
        labels = components(links)
        if step == "bridges":
            # One document of each component, the most similar one, goes to the block of a leader.
            asked = votes.where(F.col("v") >= least(F.col("n"), percent)).select("node", "leader", "v")
            lead = _labelled(blocks, labels).select(F.col("node").alias("leader"), "block", F.col("component").alias("theirs"))
            at = _labelled(asked, labels).join(lead, "leader").where("component <> theirs")
            visits = at.groupBy("component", "leader", "block").agg(F.max_by("node", F.struct("v", -F.col("node"))).alias("node"))
            visits = visits.select("node", "component", "block").distinct()
        else:
            placed = stored(_labelled(entries.select("key", "node", "n"), labels), "placed")
            mixed = placed.groupBy("key").agg(F.min("component").alias("low"), F.max("component").alias("high")).where("low <> high")
            left = placed.join(mixed.select("key"), "key").groupBy("node", "n", "component").agg(F.count("*").alias("shared"))
            left = left.where(F.col("shared") >= least(F.col("n"), percent)).select("node", "component").join(blocks.drop("n"), "node")
            visits = _opened_by_rare_tokens(left, tokens, percent)
        visits = stored(visits.join(blocks.withColumnRenamed("block", "_home"), "node").where("block <> _home").drop("_home"), "visits")
        if visits.isEmpty():
            continue
        slots = visits.groupBy("block").agg(_shares("slots"))
        went = visits.join(slots, "block").withColumn("slot", F.pmod(F.xxhash64("node"), "slots").cast("int"))
        visitors = went.join(tokens.select("node", "tokens"), "node").select("block", "slot", F.lit(1).alias("kind"), "node", "component", "tokens")
        members = _labelled(tokens.join(slots, "block"), labels).withColumn("slot", F.explode(F.sequence(F.lit(0), F.col("slots") - 1)))
        members = members.select("block", "slot", F.lit(0).alias("kind"), "node", "component", "tokens")
        more = stored(compare(members.unionByName(visitors), percent, within=False), step)
        links = links.unionByName(more)
        free_shuffles(spark)
    labels = nodes.select("node", "rep", "set_a", "set_b", "n_shingles").join(components(links).withColumnRenamed("id", "node"), "node")
    least_id = labels.groupBy("component").agg(F.min("rep").alias("component_id"))
    linked = labels.join(least_id, "component").select("set_a", "set_b", "n_shingles", "component_id")
    alone = nodes.join(labels.select("node"), "node", "left_anti").select("set_a", "set_b", "n_shingles", F.col("rep").alias("component_id"))
    found = stored(linked.unionByName(alone), "components")
    joined = signed.drop("keys").join(found, ["set_a", "set_b", "n_shingles"], "left")
    return joined.select("doc_id", "text_key", "n_shingles", F.when(F.col("doc_id").isNotNull(), F.coalesce("component_id", "doc_id")).alias("component_id"))


def one_of_each(docs: DataFrame) -> DataFrame:
    """The rows of docs without those that link to a document of a smaller id; of rows equal in id and text one stays. Rows without an id stay."""
    since = tables_made()
    found = stored(near_duplicates(docs), "near-duplicates").where("doc_id is not null")
    drop_tables(docs.sparkSession, since, [last_made()])
    free_shuffles(docs.sparkSession)
    gone = found.where("doc_id <> component_id").select("doc_id", "text_key").distinct()
    twice = found.where("doc_id = component_id").groupBy("doc_id", "text_key").agg(F.count("*").alias("n")).where("n > 1").select("doc_id", "text_key")
    number, key = fresh(docs, "__doc", "__text")
    named = docs.withColumns({number: F.col("doc_id").cast("long"), key: F.xxhash64(F.col("text").cast("string"))})
    gone, twice = stored(gone, "gone"), stored(twice, "twice")

    def among(keys: DataFrame, how: str, rows: DataFrame) -> DataFrame:
        keys = keys.select(F.col("doc_id").alias(number), F.col("text_key").alias(key))
        return rows.join(F.broadcast(keys) if keys.count() <= BROADCAST_ROWS else keys, [number, key], how)

    kept = among(gone, "left_anti", named)
    if not twice.isEmpty():
        once = among(twice, "left_semi", kept).dropDuplicates(["doc_id", "text"])
        kept = among(twice, "left_anti", kept).unionByName(once)
    return kept.select(*docs.columns)


#: Every pair of documents that share a shingle, and components by reach.
OP9_SQL = f"""
WITH RECURSIVE cut AS (SELECT doc_id, coalesce(regexp_extract_all(translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\\x20\\x09-\\x0D]+'), []) AS w FROM documents),
    shingles AS (SELECT DISTINCT doc_id, unnest(CASE WHEN len(w) = 0 THEN [] WHEN len(w) < {WORDS} THEN [array_to_string(w, ' ')] ELSE [array_to_string(w[i:i + {WORDS - 1}], ' ') for i in range(1, len(w) - {WORDS - 2})] END) AS g FROM cut),
    sizes AS (SELECT doc_id, count(*) AS n FROM shingles GROUP BY doc_id),
    pairs AS (SELECT a.doc_id AS a, b.doc_id AS b, count(*) AS c FROM shingles a JOIN shingles b ON a.g = b.g AND a.doc_id < b.doc_id GROUP BY ALL),
    links AS (SELECT a, b FROM pairs JOIN sizes x ON x.doc_id = a JOIN sizes y ON y.doc_id = b WHERE 100 * c >= {PERCENT} * (x.n + y.n - c)),
    ways AS (SELECT a, b FROM links UNION ALL SELECT b, a FROM links),
    reach AS (SELECT DISTINCT a AS doc_id, a AS root FROM ways UNION SELECT w.b, r.root FROM reach r JOIN ways w ON w.a = r.doc_id WHERE r.root < w.b)
SELECT d.doc_id, coalesce(s.n, 0) AS n_shingles, coalesce(m.root, d.doc_id) AS component_id
FROM documents d LEFT JOIN sizes s USING (doc_id) LEFT JOIN (SELECT doc_id, min(root) AS root FROM reach GROUP BY doc_id) m USING (doc_id)"""


def op9_ngram_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    return near_duplicates(table(spark, sf_dir, "documents")).drop("text_key")
