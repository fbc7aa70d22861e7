"""Line dedup with a log-template tree: lines of recurring templates are dropped.

The tree has fixed depth: a line goes to a leaf by its word count and its first ``depth`` words,
words with a digit standing for any such word. In a leaf, words are constant or variable relative
to the leaf: a word's level is how often the leaf's contexts must be halved to get down to those
that have the word at its place, and a word with fewer than ``min_docs`` contexts is always
variable. At each level, the words of that level or a more common one are the constants of a line
and in their places form a template; so a line has a few nested templates, and a field whose
values are at most half as common as the constants is left out of one of them, however large the
corpus. Smaller templates in the same leaf are found too, except where a value of their field is
more common at that place in another template than their own constants are. A line goes from all documents
if one of its templates has at least ``min_constant`` of its words constant and recurs in at least
``min_docs`` contexts.

The context of a line is what the rest of its text stands on, apart from the lines of its own leaf.
The other lines are put in bands by how many distinct texts have their leaf (1, 2-3, 4-7, ...), and
words are summed from the rarest band on; the band where the sum reaches ``own_share`` of the other
words counts. In the first band that is the text itself: it has that much of its own, so it is a
document apart however many common lines it holds. In any other band it is the smallest hash of
the band's lines, which copies of one document share, while lines of commoner bands have no say.
So texts with less than ``own_share`` of their own count as copies of what they share, and copied
documents, whose lines always come together, keep them: a template needs contexts for at least
``min_spread`` of the documents that it occurs in.

All decisions belong to line contents, hence to texts: rows with equal texts share them through
a text hash. One scan computes leaves with array operations per text; only leaves of two or more
texts are brought together again for each text, and only the lines of recurring leaves are looked
at word by word. Every count is a two-step aggregate, so one very common line is combined before
any shuffle.

Defined results: NULL stays NULL; lines of fewer than ``min_words`` words are kept; the rest of
a text keeps its lines in order, joined by line breaks; a text may become empty; repeated rows
are treated alike; an empty table gives an empty result; columns named like the added ones are
replaced.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from kpiloom.llm.common import (
    cut, forget_all_but, mix, prefix_sums, range_hashes, scratch, set_aside, utf8, value_key, without, word_bounds,
)

_STEP = np.uint64(0x9FB21C651E98DF25)


@dataclass(frozen=True)
class Settings:
    depth: int = 4
    min_words: int = 3
    min_docs: int = 10
    min_spread: float = 0.5
    own_share: float = 0.25
    min_constant: float = 0.7
    chunk: int = 1 << 17


def _parse(data: bytes) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """Word hashes with digit-bearing words masked, each word's line, and per line: count, hash."""
    array = np.frombuffer(data, dtype=np.uint8)
    breaks = np.flatnonzero(array == 10)
    sums = prefix_sums(array)
    begin, end = np.append(0, breaks + 1), np.append(breaks, len(array))
    lines = range_hashes(sums, begin, end)
    starts, ends = word_bounds(array)
    words = range_hashes(sums, starts, ends)
    digits = np.append(0, np.cumsum((array >= 48) & (array <= 57)))
    words[digits[ends] > digits[starts]] = 1
    of = np.searchsorted(breaks, starts)
    return words, of, np.bincount(of, minlength=len(lines)), lines


def _leaves(words: np.ndarray, counts: np.ndarray, depth: int) -> np.ndarray:
    first = np.append(0, np.cumsum(counts)[:-1])
    leaf = counts.astype(np.uint64)
    for k in range(depth):
        there = counts > k
        step = np.zeros(len(counts), dtype=np.uint64)
        step[there] = words[first[there] + k]
        leaf = mix(leaf * _STEP + step)
    return leaf


def _signed(x: np.ndarray) -> np.ndarray:
    return x.astype(np.uint64).view(np.int64)


def _lines(docs: DataFrame, settings: Settings) -> DataFrame:
    """_key (text hash), leaf, words, total: one row per document and leaf; words of its lines and of all lines.

    ``words`` is negative where the lines are too short to be dropped.
    """

    def told(keys: list[int], texts: list[bytes]) -> pd.DataFrame:
        words, of, counts, _ = _parse(b"\n".join(texts))
        # The lines of all texts follow each other; no word goes across their breaks.
        text = np.repeat(np.arange(len(texts)), [t.count(b"\n") + 1 for t in texts])
        total = np.bincount(text, weights=counts, minlength=len(texts)).astype(np.int64)
        filled = np.flatnonzero(counts > 0)
        leaf, text, size = _leaves(words, counts, settings.depth)[filled], text[filled], counts[filled]
        order = np.lexsort((leaf, text))
        leaf, text, size = leaf[order], text[order], size[order]
        first = np.flatnonzero(np.append(True, (leaf[1:] != leaf[:-1]) | (text[1:] != text[:-1]))[: len(leaf)])
        times = np.diff(np.append(first, len(leaf)))
        size, text = size[first], text[first]
        mass = np.where(size < settings.min_words, -size, size) * times
        return pd.DataFrame({
            "_key": np.array(keys, dtype=np.int64)[text], "leaf": _signed(leaf[first]), "words": mass.astype(np.int32),
            "total": total[text].astype(np.int32)})

    def run(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for frame in frames:
            keys, texts, size = [], [], 0
            for key, text in zip(frame["_key"], frame["text"]):
                keys.append(key)
                texts.append(utf8(text))
                size += len(texts[-1])
                if size >= settings.chunk:
                    yield told(keys, texts)
                    keys, texts, size = [], [], 0
            if keys:
                yield told(keys, texts)

    return docs.select(value_key().alias("_key"), "text").mapInPandas(
        run, "_key long, leaf long, words int, total int")


def contexts(
    key: np.ndarray, leaf: np.ndarray, words: np.ndarray, texts: np.ndarray, total: np.ndarray, own_share: float
) -> np.ndarray:
    """The context of each leaf that other texts have too, row by row.

    Rows of one text (``key``) follow each other; ``texts``: how many have the leaf; ``total``: the words
    of the row's text.
    """
    text = np.cumsum(np.append(True, key[1:] != key[:-1])[: len(key)]) - 1
    band = np.frexp(texts.astype(np.float64))[1] - 1
    n = int(band.max(initial=0)) + 1
    start = np.flatnonzero(np.append(True, key[1:] != key[:-1])[: len(key)])
    mass = np.bincount(text * n + band, weights=words, minlength=len(start) * n).reshape(-1, n)
    mass[:, 0] = total[start] - mass.sum(axis=1)
    order = np.lexsort((leaf, band, text))
    first = np.searchsorted((text * n + band)[order], np.arange(len(start) * n)).reshape(-1, n)
    ranked = leaf[order]
    sums = np.cumsum(mass, axis=1)[text] - words[:, None] * (np.arange(n) >= band[:, None])
    rest = total - words
    found = np.argmax((sums > 0) & (sums >= own_share * rest[:, None]), axis=1)
    at = np.minimum(first[text, found], len(leaf) - 1)
    low = np.where(ranked[at] == leaf, ranked[np.minimum(at + 1, len(leaf) - 1)], ranked[at])
    return np.where(rest == 0, 0, np.where(found == 0, key, low))


def _placed(lines: DataFrame, settings: Settings) -> DataFrame:
    """_key, leaf, context, _copies: the leaves of ``min_docs`` texts or more in each text, and its documents."""
    by_text = cut(lines.groupBy("_key", "leaf", "words", "total").agg(F.count(F.lit(1)).alias("_copies")))
    shared = by_text.groupBy("leaf").agg(F.count(F.lit(1)).alias("texts")).where("texts > 1")
    of_text = (
        by_text.join(shared, "leaf").groupBy("_key", "total", "_copies")
        .agg(F.collect_list(F.struct("leaf", "words", "texts")).alias("_lines"))
        .where(F.exists("_lines", lambda x: (x["texts"] >= settings.min_docs) & (x["words"] > 0)))
        .select("_key", "total", "_copies", F.col("_lines.leaf").alias("leaf"), F.col("_lines.words").alias("words"),
                F.col("_lines.texts").alias("texts")))

    def run(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for frame in frames:
            if not len(frame):
                continue
            sizes = [len(x) for x in frame["leaf"]]
            key, total, copies = (np.repeat(frame[c].to_numpy(), sizes) for c in ("_key", "total", "_copies"))
            leaf, words, texts = (np.concatenate(frame[c].tolist()) for c in ("leaf", "words", "texts"))
            found = contexts(key, leaf, np.abs(words), texts, total, settings.own_share)
            keep = (texts >= settings.min_docs) & (words > 0)
            yield pd.DataFrame({"_key": key[keep], "leaf": leaf[keep], "context": found[keep], "_copies": copies[keep]})

    return of_text.mapInPandas(run, "_key long, leaf long, context long, _copies long")


def _recurring(rows: DataFrame, by: list[str], settings: Settings) -> DataFrame:
    """The ``by`` values seen in enough contexts, and how many. Two-step: each context is counted once."""
    return (
        rows.groupBy(*by, "context").agg(F.count(F.lit(1)).alias("_n"))
        .groupBy(*by).agg(F.count(F.lit(1)).alias("_contexts"))
        .where(F.col("_contexts") >= settings.min_docs)
    )


def _levels(spelled: DataFrame, settings: Settings) -> DataFrame:
    """leaf, place, word, level: 0 for words in all contexts of the leaf, one more for each halving."""
    held = cut(_recurring(spelled, ["leaf", "place", "word"], settings))
    most = held.groupBy("leaf").agg(F.max("_contexts").alias("_most"))
    level = F.ceil(F.log2(F.col("_most") / F.col("_contexts"))).cast("int")
    return held.join(most, "leaf").select("leaf", "place", "word", level.alias("level"))


def _templates(docs: DataFrame, settings: Settings) -> DataFrame:
    """_key, no (line), leaf, template, context, _copies: the templates that each line of a busy leaf fits."""
    placed = cut(_placed(_lines(docs, settings), settings))
    wanted = (
        placed.join(_recurring(placed, ["leaf"], settings).select("leaf"), "leaf", "left_semi")
        .groupBy("_key").agg(F.collect_list(F.struct("leaf", "context")).alias("_of"))
        .select("_key", F.col("_of.leaf").alias("_leaves"), F.col("_of.context").alias("_contexts"))
    )

    def words_of(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for frame in frames:
            out = []
            for key, text, leaves, found in zip(frame["_key"], frame["text"], frame["_leaves"], frame["_contexts"]):
                words, of, counts, _ = _parse(utf8(text))
                order = np.argsort(leaves)
                leaves, found = leaves[order], found[order]
                leaf = _signed(_leaves(words, counts, settings.depth))
                at = np.minimum(np.searchsorted(leaves, leaf), len(leaves) - 1)
                chosen = ((leaves[at] == leaf) & (counts > 0))[of]
                line = of[chosen]
                place = np.flatnonzero(chosen) - np.append(0, np.cumsum(counts)[:-1])[line]
                out.append((np.full(len(line), key), line, leaf[line], found[at[line]], counts[line], place, words[chosen]))
            if out:
                key, line, leaf, context, counts, place, words = (np.concatenate(x) for x in zip(*out))
                yield pd.DataFrame({
                    "_key": key, "no": line.astype(np.int32), "leaf": leaf, "context": context,
                    "words": counts.astype(np.int32), "place": place.astype(np.int32), "word": _signed(words)})

    texts = docs.select(value_key().alias("_key"), "text")
    spelled = cut(texts.join(wanted, "_key").mapInPandas(
        words_of, "_key long, no int, leaf long, context long, words int, place int, word long"))
    line = ["_key", "no", "leaf", "context", "words"]
    upward = Window.partitionBy(*line).orderBy("level").rowsBetween(Window.unboundedPreceding, Window.currentRow)
    templates = (
        spelled.join(_levels(spelled, settings), ["leaf", "place", "word"])
        .groupBy(*line, "place", "word", "level").agg(F.count(F.lit(1)).alias("_copies"))
        .repartition("_key", "no")
        .groupBy(*line, "level")
        .agg(F.bit_xor(F.xxhash64("place", "word")).alias("_hash"), F.count(F.lit(1)).alias("_n"),
             F.min("_copies").alias("_copies"))
        .select(*line, F.bit_xor("_hash").over(upward).alias("template"), F.sum("_n").over(upward).alias("_fixed"),
                F.min("_copies").over(upward).alias("_copies"))
        .where(F.col("_fixed") >= settings.min_constant * F.col("words"))
    )
    return cut(templates)


def drop_lines(docs: DataFrame, settings: Settings = Settings()) -> DataFrame:
    """``docs`` with shortened texts, plus n_lines and n_dropped; ``n_chars``, if there, is counted again."""
    own = without(docs, "n_lines", "n_dropped")
    docs = base = set_aside(own, "doc_id", "text", "n_chars")
    columns = base.columns
    with scratch() as made:
        templates = _templates(docs, settings)
        forget_all_but(made, templates)
    common = (
        templates.groupBy("leaf", "template", "context").agg(F.sum("_copies").alias("_n"))
        .groupBy("leaf", "template").agg(F.count(F.lit(1)).alias("_contexts"), F.sum("_n").alias("_docs"))
        .where((F.col("_contexts") >= settings.min_docs)
               & (F.col("_contexts") >= settings.min_spread * F.col("_docs")))
    )
    drops = (
        templates.join(common.select("leaf", "template"), ["leaf", "template"], "left_semi")
        .groupBy("_key").agg(F.collect_set("no").alias("_drop"))
    )

    @F.pandas_udf("string")
    def kept(texts: pd.Series, drops: pd.Series) -> pd.Series:
        out = []
        for text, gone in zip(texts, drops):
            if text is None or gone is None:
                out.append(None)
                continue
            away = set(gone.tolist())
            out.append("\n".join(x for k, x in enumerate(text.split("\n")) if k not in away))
        return pd.Series(out, dtype=object)

    joined = base.withColumn("_key", value_key()).join(drops, "_key", "left")
    n_lines = F.when(F.col("text").isNull(), 0).otherwise(F.size(F.split("text", "\n")))
    shorter = kept(F.when(F.col("_drop").isNotNull(), F.col("text")), F.col("_drop"))
    out = joined.withColumns({
        "n_lines": n_lines.cast("long"),
        "n_dropped": F.when(F.col("text").isNull() | F.col("_drop").isNull(), 0).otherwise(F.size("_drop")).cast("long"),
        "text": F.coalesce(shorter, F.col("text")),
    })
    if "n_chars" in columns:
        out = out.withColumn("n_chars", F.coalesce(F.length("text"), F.lit(0)).cast(base.schema["n_chars"].dataType))
    return out.select(*columns, "n_lines", "n_dropped").toDF(*own.columns, "n_lines", "n_dropped")
