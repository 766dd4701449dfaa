"""SentencePiece BPE encoding by vectorised merge rounds, and decoding.

Text is escaped (a space becomes U+2581, one is put in front) and cut before each run of U+2581: no piece of the model
reaches across such a cut, which is checked when the model is loaded. Distinct words of a batch are encoded together:
one flat numpy array of symbols with a rank per neighbouring pair; each round takes the segmented minimum rank of every
word, merges the leftmost occurrences that don't overlap, and compacts the array, until no pair is left. Where a merge
makes a pair that would have to come before the other occurrences, that word merges its leftmost occurrence only, so
the result is that of the library's priority queue.

Defined results: null or empty text has only the end id. Characters outside the model become byte pieces. Rows that
repeat, very long texts and words without spaces are encoded whole; extra columns are ignored; an empty table gives an
empty result.
"""

from __future__ import annotations

import hashlib
import re
from collections.abc import Iterator

import numpy as np
import public_tokenizers
import pyarrow as pa
import sentencepiece
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .shared import keep_only, slices, table

SPACE = "▁"
NONE = np.int32(2**31 - 1)
#: Symbols from here on are characters that no piece holds.
STRANGE = 1 << 20
#: Distinct words encoded at once.
WORDS_AT_ONCE = 100_000
#: Distinct words in each of the two generations that a worker keeps (about 350 bytes each), and the longest one kept.
WORDS_KEPT, KEPT_CHARS = 125_000, 40


class PieceModel:
    """Pieces, ranks and the pair table of a SentencePiece BPE model with byte fallback and identity normalisation."""

    def __init__(self, path: str):
        sp = sentencepiece.SentencePieceProcessor(model_file=path)
        n = sp.get_piece_size()
        self.pieces = [sp.id_to_piece(i) for i in range(n)]
        special = [sp.is_control(i) or sp.is_unknown(i) or sp.is_byte(i) for i in range(n)]
        normal = {p: i for i, p in enumerate(self.pieces) if not special[i]}
        self.byte_id = {int(self.pieces[i][3:5], 16): i for i in range(n) if sp.is_byte(i)}
        self.bytes_of = {i: b for b, i in self.byte_id.items()}
        self.numbers = list(map(str, range(n)))
        self.end = sp.eos_id()
        if any(SPACE in p.lstrip(SPACE) for p in normal):
            raise ValueError("a piece reaches across a word")
        if len(self.byte_id) != 256:
            raise ValueError("the model has no byte fallback")
        chars = sorted({c for p in normal for c in p})
        #: Characters that only occur inside longer pieces are symbols, but no ids.
        inner = {c: n + k for k, c in enumerate(c for c in chars if c not in normal)}
        self.char_of = {s: c for c, s in inner.items()}
        symbol = inner | normal
        self.symbol_of = np.arange(0x110000, dtype=np.int32) + STRANGE
        for c in chars:
            self.symbol_of[ord(c)] = symbol[c]
        pairs, merged = [], []
        for p, i in normal.items():
            for cut in range(1, len(p)):
                a, b = symbol.get(p[:cut]), symbol.get(p[cut:])
                if a is not None and b is not None:
                    pairs.append(a << 32 | b)
                    merged.append(i)
        order = np.argsort(pairs)
        self.pairs, self.merged = np.array(pairs, np.int64)[order], np.array(merged, np.int32)[order]
        scores = np.array([sp.get_score(int(i)) for i in self.merged])
        self.rank = np.unique(-scores, return_inverse=True)[1].astype(np.int32)
        self.young: dict[str, tuple[str, int, str]] = {}
        self.old: dict[str, tuple[str, int, str]] = {}

    def look_up(self, a: np.ndarray, b: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Rank (NONE: no piece) and merged piece of each pair."""
        key = a.astype(np.int64) << 32 | b
        at = np.minimum(np.searchsorted(self.pairs, key), len(self.pairs) - 1)
        hit = self.pairs[at] == key
        return np.where(hit, self.rank[at], NONE), np.where(hit, self.merged[at], -1)

    def merge(self, words: list[str]) -> tuple[np.ndarray, np.ndarray]:
        """The symbols of all words, one after another, and the number of symbols of each word."""
        lengths = np.fromiter(map(len, words), np.int64, len(words))
        sym = self.symbol_of[np.frombuffer("".join(words).encode("utf-32-le"), np.uint32)]
        word = np.repeat(np.arange(len(words), dtype=np.int32), lengths)
        rank, piece = self._pairs(sym, word)
        done_sym, done_word = [], []
        while len(sym):
            first = np.flatnonzero(np.r_[True, word[1:] != word[:-1]])
            low = np.minimum.reduceat(rank, first)
            size = np.diff(np.r_[first, len(sym)])
            if (low == NONE).any():
                over = np.repeat(low == NONE, size)
                done_sym.append(sym[over])
                done_word.append(word[over])
                sym, word, rank, piece = sym[~over], word[~over], rank[~over], piece[~over]
                size, low = size[low != NONE], low[low != NONE]
                if not len(sym):
                    break
            least = np.repeat(low, size)
            sym, word, rank, piece = self._round(sym, word, rank, piece, least)
        sym, word = np.concatenate([np.empty(0, np.int32), *done_sym]), np.concatenate([np.empty(0, np.int32), *done_word])
        order = np.argsort(word, kind="stable")
        return sym[order], np.bincount(word, minlength=len(words))

    def _pairs(self, sym: np.ndarray, word: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        rank, piece = np.full(len(sym), NONE, np.int32), np.full(len(sym), -1, np.int32)
        if len(sym) > 1:
            rank[:-1], piece[:-1] = self.look_up(sym[:-1], sym[1:])
            rank[:-1][word[1:] != word[:-1]] = NONE
        return rank, piece

    def _round(self, sym, word, rank, piece, least):
        at = _leftmost(np.flatnonzero(rank == least))
        early = self._early(at, sym, word, piece, least)
        if early.any():
            # Words in which a new pair comes first merge their leftmost occurrence only.
            bad = np.zeros(int(word[-1]) + 1, bool)
            bad[word[at[early]]] = True
            head = np.r_[True, word[at[1:]] != word[at[:-1]]]
            at = at[head | ~bad[word[at]]]
        new = sym.copy()
        new[at] = piece[at]
        keep = np.ones(len(sym), bool)
        keep[at + 1] = False
        place = np.cumsum(keep) - 1
        sym, word, rank, piece = new[keep], word[keep], rank[keep], piece[keep]
        touched = place[at]
        near = np.zeros(len(sym), bool)
        near[touched] = near[touched[touched > 0] - 1] = True
        touched = np.flatnonzero(near)
        inside = touched + 1 < len(sym)
        rank[touched[~inside]] = NONE
        touched = touched[inside]
        r, p = self.look_up(sym[touched], sym[touched + 1])
        r[word[touched] != word[touched + 1]] = NONE
        rank[touched], piece[touched] = r, p
        return sym, word, rank, piece

    def _early(self, at, sym, word, piece, least) -> np.ndarray:
        """Merges that make a pair of the round's rank or a lower one, with the symbols before or after them."""
        n, made = len(sym), piece[at]
        after = np.minimum(at + 2, n - 1)
        has = (at + 2 < n) & (word[after] == word[at])
        early = has & (self.look_up(made, sym[after])[0] <= least[at])
        before = np.maximum(at - 1, 0)
        left = sym[before]
        joined = np.r_[False, at[1:] - 2 == at[:-1]]
        left = np.where(joined, np.r_[0, made[:-1]], left)
        has = (at > 0) & (word[before] == word[at])
        return early | has & (self.look_up(left, made)[0] <= least[at])

    def ids_of(self, symbols: np.ndarray) -> list[int]:
        out: list[int] = []
        for s in symbols.tolist():
            if s < len(self.pieces):
                out.append(s)
            else:
                out += [self.byte_id[b] for b in (chr(s - STRANGE) if s >= STRANGE else self.char_of[s]).encode()]
        return out

    def learn(self, words: list[str]) -> dict[str, tuple[str, int, str]]:
        """For each word its ids in decimal, their number, and their text again."""
        known: dict[str, tuple[str, int, str]] = {}
        for k in range(0, len(words), WORDS_AT_ONCE):
            part = words[k : k + WORDS_AT_ONCE]
            sym, size = self.merge([SPACE + w for w in part])
            ends = np.cumsum(size)
            strange = np.add.reduceat(sym >= len(self.pieces), ends - size) > 0
            symbols = sym.tolist()
            pieces, text_of, start = self.pieces, self.numbers, 0
            for w, end, odd in zip(part, ends.tolist(), strange.tolist(), strict=True):
                if odd:
                    ids = self.ids_of(sym[start:end])
                    known[w] = (" ".join(map(str, ids)), len(ids), self.text(ids))
                else:
                    own = symbols[start:end]
                    known[w] = (" ".join([text_of[s] for s in own]), end - start, "".join([pieces[s] for s in own]))
                start = end
        return known

    def text(self, ids: list[int]) -> str:
        """Pieces in order, runs of byte pieces read as UTF-8 (each invalid byte as U+FFFD), still escaped."""
        bytes_of = self.bytes_of
        out, run = [], bytearray()
        for i in [*ids, None]:
            if i in bytes_of:
                run.append(bytes_of[i])
                continue
            if run:
                out.append(_lenient(bytes(run)))
                run.clear()
            if i is not None:
                out.append(self.pieces[i])
        return "".join(out)

    def decode(self, ids: list[int]) -> str:
        return _unescape(self.text([i for i in ids if i not in (self.end, 1)]))

    def words(self, text: str) -> list[str]:
        """The words of a text without the U+2581 that each begins with."""
        if "  " in text or SPACE in text or text[:1] == " " or text[-1:] == " ":
            return [w[1:] for w in re.findall(f"{SPACE}+[^{SPACE}]*", SPACE + text.replace(" ", SPACE))]
        return text.split(" ")

    def encode_batch(self, texts: list[str]) -> Iterator[tuple[str, int, str]]:
        """For each text, its ids in decimal with the end id, their number, and the text that they decode to."""
        cut = [self.words(t) if t else [] for t in texts]
        young, old = self.young, self.old
        asked = set().union(*cut).difference(young)
        new = self.learn([w for w in asked if w not in old])
        young.update((w, old[w]) for w in asked if w in old)
        long = {w: new.pop(w) for w in [w for w in new if len(w) > KEPT_CHARS]}
        young.update(new)
        found = young | long if long else young
        for words in cut:
            parts = [found[w] for w in words]
            ids = " ".join([p[0] for p in parts])
            yield f"{ids} {self.end}".lstrip(), sum([p[1] for p in parts]) + 1, _unescape("".join([p[2] for p in parts]))
        if len(young) > WORDS_KEPT:
            self.old, self.young = young, {}

    def encode(self, text: str) -> list[int]:
        return list(map(int, next(self.encode_batch([text]))[0].split()))


def _leftmost(at: np.ndarray) -> np.ndarray:
    """Of neighbouring places, every other one from the left."""
    start = np.r_[True, at[1:] != at[:-1] + 1]
    since = np.arange(len(at))
    since = since - np.maximum.accumulate(np.where(start, since, 0))
    return at[since % 2 == 0]


def _lenient(data: bytes) -> str:
    out, k = [], 0
    while k < len(data):
        for n in (1, 2, 3, 4):
            try:
                out.append(data[k : k + n].decode())
                k += n
                break
            except UnicodeDecodeError:
                continue
        else:
            out.append("�")
            k += 1
    return "".join(out)


def _unescape(text: str) -> str:
    return text.removeprefix(SPACE).replace(SPACE, " ")


_models: dict[str, PieceModel] = {}


def model(path: str) -> PieceModel:
    """One model for each Python worker."""
    keep_only(_models)
    if path not in _models:
        _models[path] = PieceModel(path)
    return _models[path]


def encode_pieces(docs: DataFrame, path: str, id_col: str = "doc_id", text_col: str = "text", digests: bool = False) -> DataFrame:
    """(doc_id, n_tokens, ids, decoded), or with digests their SHA-256 in hex: ids is the decimal ids joined by a space."""
    names = ("ids_sha256", "decoded_sha256") if digests else ("ids", "decoded")

    def encode(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        pieces = model(path)
        shown = (lambda s: hashlib.sha256(s.encode()).hexdigest()) if digests else str
        for batch in batches:
            n, ids, texts = [], [], []
            for part in slices(batch.column(1).to_pylist()):
                for id_text, count, text in pieces.encode_batch(part):
                    n.append(count)
                    ids.append(shown(id_text))
                    texts.append(shown(text))
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(n, pa.int64()), pa.array(ids, pa.string()), pa.array(texts, pa.string())], ["doc_id", "n_tokens", *names])

    return docs.select(F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).cast("string").alias("text")).mapInArrow(encode, f"doc_id long, n_tokens long, {names[0]} string, {names[1]} string")


def op8_piece_bpe(spark: SparkSession, sf_dir: str) -> DataFrame:
    return encode_pieces(table(spark, sf_dir, "documents"), public_tokenizers.path("piece_bpe_32k.model"), digests=True)
