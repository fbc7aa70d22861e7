"""Lexical retrieval packing: fill windows with BM25 neighbours of a seed document.

Texts become token ids in one pass, cut points in the shared folder. A sketch of each text, the
smallest hash among its token pairs, orders the rows into shards of about ``shard_tokens``
tokens: copies and related texts meet in a shard, and a sketch shared by very many rows is spread
over neighbouring shards by a hash of the id. Each shard builds a BM25 inverted index over the
parts that don't fill a window by themselves, takes the longest unused part as seed, retrieves
its unused neighbours by score and fills the window with them; the last one is cut, and its rest
stays unused. Only the last window of a shard is not full: it is split into sequences whose
lengths are powers of two, which need no padding.

A shard's task holds its ids (two bytes each) and its index; one text longer than a shard makes
that shard as large as the text. Defined results: a NULL text counts as empty and consists of the
end id alone; repeated rows are documents of their own; ties between scores or lengths go to the
document that stands first in its shard's order (sketch, hash of id and length, ids); an empty table
gives no piece; extra columns are ignored, whatever they are called.
"""

from __future__ import annotations

import json
import re
import unicodedata
from array import array
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pandas as pd
import pyarrow as pa
import pyarrow.compute as pc
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from kpiloom.llm.common import cut, give_back, mix, process_state


@dataclass(frozen=True)
class Settings:
    tokenizer: str
    window: int = 4096
    end_id: int = 2
    shard_tokens: int = 2_000_000
    k1: float = 1.2
    b: float = 0.75
    cached_words: int = 1_200_000
    slice_bytes: int = 4_000_000


# Tokenizers with these two steps before their model cut a word of printable ASCII and lower-case
# Latin letters as ``_PIECE`` does, and spell a piece byte by byte in the GPT-2 alphabet.
_STEPS = (
    {"type": "Sequence", "normalizers": [
        {"type": "NFC"}, {"type": "Replace", "pattern": {"Regex": "\\s+"}, "content": " "}, {"type": "Lowercase"}]},
    {"type": "Sequence", "pretokenizers": [
        {"type": "Split", "pattern": {"Regex": "'s|'t|'re|'ve|'m|'ll|'d|[\\p{L}]+|[\\p{N}]|[^\\s\\p{L}\\p{N}]+"},
         "behavior": "Removed", "invert": True},
        {"type": "ByteLevel", "add_prefix_space": False, "trim_offsets": True, "use_regex": False}]},
)
_LATIN = "".join(c for c in map(chr, range(0xC0, 0x250)) if c.isalpha() and c.lower() == c)
_PLAIN = re.compile(f"[!-@\\[-~{_LATIN}]+")
_PIECE = re.compile(f"'s|'t|'re|'ve|'m|'ll|'d|[a-z{_LATIN}]+|[0-9]|[^a-z0-9{_LATIN}]+")
_KEPT = [*range(33, 127), *range(161, 173), *range(174, 256)]
_BYTES = {b: chr(b) for b in _KEPT} | {b: chr(256 + k) for k, b in enumerate(b for b in range(256) if b not in _KEPT)}
_SPELLED = {ord(c): "".join(_BYTES[b] for b in c.encode()) for c in _LATIN}


class _Words(dict):
    """Ids of white-space separated pieces of text, as bytes.

    The tokenizer never joins characters across white space, so the ids of a text are those
    of its pieces. Words seen before are looked up; ``cached`` bounds what a worker keeps. It
    lowers all letters, so A-Z are lowered first and a word has one entry.
    """

    def __init__(self, path: str, cached: int):
        from tokenizers import Tokenizer

        self.tokenizer = Tokenizer.from_file(path)
        self.cached = cached
        self.type = np.dtype("<u2" if self.tokenizer.get_vocab_size() <= 1 << 16 else "<u4")
        # Texts with one of four control characters, at which Arrow splits and the tokenizer does
        # not, or with a token of the tokenizer's own are encoded as a whole.
        own = [re.escape(t.content) for t in self.tokenizer.get_added_tokens_decoder().values()]
        self.odd = "(?i)" + "|".join(["[\\x1c-\\x1f]", *own])
        steps = json.loads(self.tokenizer.to_str())
        self.model = self.tokenizer.model if (steps["normalizer"], steps["pre_tokenizer"]) == _STEPS else None

    def encode(self, text: str) -> bytes:
        return np.array(self.tokenizer.encode(text, add_special_tokens=False).ids, dtype=self.type).tobytes()

    def learn(self, words: list[str]) -> None:
        """Add words. Plain ones go to the model piece by piece, which the tokenizer's first steps would do.

        Of the others many go in one call, the offsets of the ids tell whose they are.
        """
        joint = []
        for w in words:
            if self.model and _PLAIN.fullmatch(w):
                cut_up = [w] if w.isalpha() else _PIECE.findall(w)
                for piece in cut_up:
                    if piece not in self:  # a piece by itself is a word with the same ids
                        found = self.model.tokenize(piece if piece.isascii() else piece.translate(_SPELLED))
                        self[piece] = array(self.type.char, [t.id for t in found]).tobytes()
                if len(cut_up) > 1:
                    self[w] = b"".join([self[piece] for piece in cut_up])
            elif not w or not unicodedata.is_normalized("NFC", w) or not w.isprintable():
                self[w] = self.encode(w)
            else:
                joint.append(w)
        for at in range(0, len(joint), 4096):
            part = joint[at : at + 4096]
            got = self.tokenizer.encode(" ".join(part), add_special_tokens=False)
            ids = np.array(got.ids, dtype=self.type).tobytes()
            ends = np.cumsum([len(w) + 1 for w in part])
            begins = np.array([a for a, _ in got.offsets], dtype=np.int64)
            last = np.searchsorted(begins, ends) * self.type.itemsize
            first = 0
            for w, z in zip(part, last.tolist()):
                self[w] = ids[first:z]
                first = z

    def ids(self, texts: pa.Array, end_id: int) -> tuple[np.ndarray, np.ndarray]:
        """Ids of all texts in one row, each closed by ``end_id``, and where each text ends."""
        if len(self) > self.cached:
            self.clear()
        texts = texts.fill_null("")
        words = pc.utf8_split_whitespace(pc.ascii_lower(texts))
        coded = words.flatten().dictionary_encode()
        unique = coded.dictionary.to_numpy(zero_copy_only=False).tolist()
        held = list(map(self.get, unique))
        self.learn([w for w, ids in zip(unique, held) if ids is None])
        held = [self[w] if ids is None else ids for w, ids in zip(unique, held)]
        width = self.type.itemsize
        pool = np.frombuffer(b"".join(held), dtype=self.type)
        sizes = np.fromiter(map(len, held), dtype=np.int32, count=len(held)) // width
        at = coded.indices.to_numpy()
        n = sizes[at]
        until = np.cumsum(n, dtype=np.int64)
        # A slice has far fewer ids than an int32 counts, unless one text is larger than that.
        place = np.int32 if not len(n) or until[-1] < 1 << 31 else np.int64
        shift = (np.cumsum(sizes, dtype=np.int64) - sizes)[at] - (until - n)
        out = pool[np.repeat(shift.astype(place), n) + np.arange(until[-1] if len(n) else 0, dtype=place)]
        bounds = words.offsets.to_numpy()
        ends = np.append(0, until)[bounds[1:] - bounds[0]]
        odd = pc.match_substring_regex(texts, self.odd).to_numpy(zero_copy_only=False)
        if odd.any():
            parts = np.split(out, ends[:-1])
            for k in np.flatnonzero(odd):
                parts[k] = np.frombuffer(self.encode(texts[int(k)].as_py()), dtype=self.type)
            out, ends = np.concatenate(parts), np.cumsum([len(x) for x in parts])
        return np.insert(out, ends, end_id), ends + np.arange(1, len(ends) + 1)


def _words(settings: Settings) -> _Words:
    kept = process_state().setdefault("tokenizers", {})
    if settings.tokenizer not in kept:
        give_back()
        kept[settings.tokenizer] = _Words(settings.tokenizer, settings.cached_words)
    return kept[settings.tokenizer]


def _sketches(ids: np.ndarray, ends: np.ndarray) -> np.ndarray:
    """The smallest hash among each text's token pairs, -1 without a pair; every text has a token."""
    wide = ids.astype(np.uint64)
    pairs = np.append(mix((wide[:-1] << np.uint64(32)) | wide[1:]) >> np.uint64(1), np.uint64(0))
    pairs[ends - 1] = np.iinfo(np.uint64).max  # the pair of a text's last token and the next text's first
    lowest = np.minimum.reduceat(pairs, np.append(0, ends[:-1]))
    return lowest.view(np.int64)


def _slices(batch: pa.RecordBatch, most: int) -> Iterator[pa.RecordBatch]:
    """Parts of the batch of about ``most`` bytes of text each."""
    size = pc.fill_null(pc.binary_length(batch.column("text")), 0).to_numpy(zero_copy_only=False)
    part = np.cumsum(size.astype(np.int64)) // most
    first = np.flatnonzero(np.append(True, part[1:] != part[:-1]))
    for a, z in zip(first.tolist(), np.append(first[1:], len(size)).tolist()):
        yield batch.slice(a, z - a)


def tokenise(docs: DataFrame, settings: Settings) -> DataFrame:
    """doc_id, ids (little-endian, two bytes each if the vocabulary allows, with the end id), n, sketch."""
    kind = docs.schema["doc_id"].dataType.simpleString()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        words = _words(settings)
        width = words.type.itemsize
        for batch in batches:
            if not batch.num_rows:
                continue
            for part in _slices(batch, settings.slice_bytes):
                ids, ends = words.ids(part.column("text"), settings.end_id)
                offsets = np.append(0, ends * width).astype(np.int32)
                yield pa.RecordBatch.from_arrays([
                    part.column("doc_id"),
                    pa.Array.from_buffers(pa.binary(), len(ends), [None, pa.py_buffer(offsets), pa.py_buffer(ids)]),
                    pa.array(np.diff(ends, prepend=0), pa.int64()),
                    pa.array(_sketches(ids, ends), pa.int64()),
                ], names=["doc_id", "ids", "n", "sketch"])

    return docs.select("doc_id", "text").mapInArrow(run, f"doc_id {kind}, ids binary, n long, sketch long")


class _Index:
    """BM25 postings of one shard, by token id."""

    def __init__(self, parts: list[np.ndarray], settings: Settings):
        self.settings, self.size = settings, len(parts)
        sizes = np.array([len(p) for p in parts], dtype=np.int64)
        doc = np.repeat(np.arange(len(parts), dtype=np.int64), sizes)
        keys = np.concatenate(parts).astype(np.int64) * max(1, len(parts)) + doc if len(parts) else np.zeros(0, np.int64)
        keys, tf = np.unique(keys, return_counts=True)
        term, self.doc = keys // max(1, len(parts)), (keys % max(1, len(parts))).astype(np.int64)
        self.terms, self.first = np.unique(term, return_index=True)
        self.last = np.append(self.first[1:], len(term))
        df = self.last - self.first
        idf = np.log1p((len(parts) - df + 0.5) / (df + 0.5))
        length = settings.k1 * (1 - settings.b + settings.b * sizes / max(1.0, sizes.mean() if len(sizes) else 1.0))
        self.weight = np.repeat(idf, df) * tf * (settings.k1 + 1) / (tf + length[self.doc])
        # A document's query are all its distinct terms; one that nobody else has finds nobody.
        rank = np.repeat(np.arange(len(self.terms)), df)
        others = np.flatnonzero(np.repeat(df, df) > 1)
        by = others[np.argsort(self.doc[others], kind="stable")]
        bounds = np.searchsorted(self.doc[by], np.arange(len(parts) + 1))
        self.queries = [rank[by[a:z]] for a, z in zip(bounds[:-1], bounds[1:])]

    def scores(self, seed: int) -> np.ndarray:
        terms = self.queries[seed]
        if not len(terms):
            return np.zeros(self.size)
        sizes = self.last[terms] - self.first[terms]
        ends = np.cumsum(sizes)
        rows = np.arange(ends[-1]) + np.repeat(self.first[terms] - (ends - sizes), sizes)
        return np.bincount(self.doc[rows], weights=self.weight[rows], minlength=self.size)


def _windows(sizes: list[int], parts: list[np.ndarray], settings: Settings) -> Iterator[list[tuple[int, int, int]]]:
    """Windows as lists of (document, start, length); sizes: tokens of each document."""
    window = settings.window
    start = np.array([n - n % window for n in sizes], dtype=np.int64)
    left = np.array(sizes, dtype=np.int64) - start
    for d, n in enumerate(sizes):
        for at in range(0, n - n % window, window):
            yield [(d, at, window)]
    index = _Index(parts, settings)
    order = np.argsort(-left, kind="stable")
    nxt = 0
    carried = -1
    while True:
        while nxt < len(order) and left[order[nxt]] == 0:
            nxt += 1
        if carried >= 0 and left[carried]:
            seed = carried
        elif nxt < len(order):
            seed = int(order[nxt])
        else:
            return
        filled = [(seed, int(start[seed]), int(left[seed]))]
        room = window - int(left[seed])
        start[seed] += left[seed]
        left[seed] = 0
        carried = -1
        if room:
            scores = np.where(left > 0, index.scores(seed), -1.0)
            found = np.flatnonzero(scores > 0)
            found = found[np.lexsort((found, -scores[found]))]
            at = nxt
            k = 0
            while room:
                if k < len(found):
                    d = int(found[k])
                    k += 1
                else:  # no related text is left: take the longest ones
                    while at < len(order) and left[order[at]] == 0:
                        at += 1
                    if at == len(order):
                        break
                    d = int(order[at])
                take = min(room, int(left[d]))
                if take == 0:
                    continue
                filled.append((d, int(start[d]), take))
                start[d] += take
                left[d] -= take
                room -= take
                if left[d]:
                    carried = d
        yield filled


def _powers(filled: list[tuple[int, int, int]], window: int) -> Iterator[list[tuple[int, int, int]]]:
    """Split a window into sequences whose lengths are powers of two."""
    total = sum(n for _, _, n in filled)
    if total == window or total & (total - 1) == 0:
        yield filled
        return
    room, out = 1 << (total.bit_length() - 1), []
    for d, at, n in filled:
        while n:
            take = min(room, n)
            out.append((d, at, take))
            at, n, room, total = at + take, n - take, room - take, total - take
            if room == 0:
                yield out
                out, room = [], 1 << (total.bit_length() - 1) if total else 0
    if out:
        yield out


def pack(docs: DataFrame, settings: Settings) -> DataFrame:
    """doc_id, start, length, ids (little-endian unsigned 32-bit), doc_tokens, sequence_id, offset."""
    kind = docs.schema["doc_id"].dataType.simpleString()
    tokens = cut(tokenise(docs, settings))
    total = tokens.agg(F.coalesce(F.sum("n"), F.lit(0))).first()[0]
    shards = max(1, -(-total // settings.shard_tokens))
    out = f"doc_id {kind}, start long, length long, ids binary, doc_tokens long, sequence_id long, offset long"

    def run(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        width = _words(settings).type
        names, parts, whole = [], [], []
        for frame in frames:
            names.extend(frame["doc_id"].tolist())
            whole.extend(np.frombuffer(x, width) for x in frame["ids"])
        sizes = [len(x) for x in whole]
        parts = [x[len(x) - len(x) % settings.window :] for x in whole]
        number = TaskContext.get().partitionId() << 32
        rows: list[tuple] = []
        for filled in _windows(sizes, parts, settings):
            for sequence in _powers(filled, settings.window):
                offset = 0
                for d, at, n in sequence:
                    rows.append((names[d], at, n, whole[d][at : at + n].astype("<u4").tobytes(), sizes[d], number, offset))
                    offset += n
                number += 1
            if len(rows) >= 512:
                yield pd.DataFrame(rows, columns=["doc_id", "start", "length", "ids", "doc_tokens", "sequence_id", "offset"])
                rows = []
        if rows:
            yield pd.DataFrame(rows, columns=["doc_id", "start", "length", "ids", "doc_tokens", "sequence_id", "offset"])

    spread = tokens.withColumn("_spread", F.xxhash64("doc_id", "n"))
    return (
        spread.repartitionByRange(shards, "sketch", "_spread")
        .sortWithinPartitions("sketch", "_spread", "ids")
        .select("doc_id", "ids")
        .mapInPandas(run, out)
    )
