"""Repeated byte windows by a depth-limited radix sort of suffixes.

A window of ``threshold`` bytes is repeated if the same bytes start anywhere else. Suffixes are
ordered only through that many bytes, most significant digit first, and a suffix leaves the sort
as soon as it is alone in its group; those that stay equal through all bytes are the repeated
windows. Every window is a suffix's first ``threshold`` bytes, and its first digit is not its
first bytes but the smallest hash among its ``gram``-byte pieces: equal windows have equal
digits, and one digit serves the whole run of windows around it, so the first pass moves one row
per run (some 185 windows) in place of one per byte.

1. First digit: a count of the grams finishes all runs that are alone with theirs. The others
   become rows (gram, context), context being the bytes of the run's windows. Equal contexts of
   different places are repeated as a whole; a gram with one context is finished.
2. Next digits: runs whose gram has several contexts bring those bytes along and are compared
   window by window in groups of one gram.
3. A gram with more than ``group`` different contexts is not gathered: each task compares the windows
   it meets, and one row per task and window is sorted to find those that only meet elsewhere.

Texts are keyed by their hash, so copies of a text are handled once; a text that two rows have is
repeated throughout. Everything that is gathered belongs to one text or to ``group`` runs.

Defined results: NULL counts as empty; texts below ``threshold`` bytes lose nothing; repeated
rows are places of their own; an empty table gives an empty result; columns named like the added
ones are replaced.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from kpiloom.llm.common import cut, forget, mix, prefix_sums, range_hashes, stored, utf8, value_key, without

_CHUNK = 1 << 23
_PLACE = np.uint64((1 << 24) - 1)


@dataclass(frozen=True)
class Settings:
    threshold: int = 400
    gram: int = 32
    group: int = 4096


def runs(data: bytes, settings: Settings) -> tuple[np.ndarray, ...]:
    """Runs of windows with one digit: gram hash, context hash, first and last window start."""
    array = np.frombuffer(data, dtype=np.uint8)
    span = settings.threshold - settings.gram + 1
    found: list[tuple[np.ndarray, ...]] = []
    for at in range(0, max(0, len(array) - settings.threshold + 1), _CHUNK):
        part = array[at : at + _CHUNK + settings.threshold - 1]
        sums = prefix_sums(part)
        places = np.arange(len(part) - settings.gram + 1)
        grams = range_hashes(sums, places, places + settings.gram)
        # The upper bits order the pieces of a window, its first piece wins a tie.
        value = (grams & ~_PLACE) | places.astype(np.uint64)
        blocks = -(-len(value) // span) * span
        padded = np.full(blocks, np.iinfo(np.uint64).max, dtype=np.uint64)
        padded[: len(value)] = value
        rows = padded.reshape(-1, span)
        ahead = np.minimum.accumulate(rows, axis=1).ravel()
        behind = np.minimum.accumulate(rows[:, ::-1], axis=1)[:, ::-1].ravel()
        n = len(part) - settings.threshold + 1
        low = np.minimum(behind[:n], ahead[span - 1 : span - 1 + n])
        first = np.flatnonzero(np.append(True, low[1:] != low[:-1]))
        last = np.append(first[1:], n) - 1
        place = (low[first] & _PLACE).astype(np.int64)
        context = mix(range_hashes(sums, first, last + settings.threshold) + (place - first).astype(np.uint64))
        found.append((grams[place], context, first + at, last + at))
    if not found:
        return tuple(np.zeros(0, t) for t in (np.uint64, np.uint64, np.int64, np.int64))
    return tuple(np.concatenate(x) for x in zip(*found))


def _runs(docs: DataFrame, settings: Settings) -> DataFrame:
    """_key and arrays gram, context, first, n (windows): once per text and task."""

    def run(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        seen: set[int] = set()
        for frame in frames:
            out = []
            for key, text in zip(frame["_key"], frame["text"]):
                if key in seen:
                    continue
                if len(seen) < 1_000_000:
                    seen.add(key)
                gram, context, first, last = runs(utf8(text), settings)
                if len(gram):
                    out.append((
                        key, gram.view(np.int64), context.view(np.int64), first.astype(np.int32),
                        (last - first + 1).astype(np.int32)))
            if out:
                yield pd.DataFrame(out, columns=["_key", "gram", "context", "first", "n"])

    return docs.select(value_key().alias("_key"), "text").mapInPandas(
        run, "_key long, gram array<long>, context array<long>, first array<int>, n array<int>")


def _keys(docs: DataFrame) -> DataFrame:
    """_key, _id (the smallest doc_id with this text), _copied (several rows have it)."""
    return docs.groupBy(value_key().alias("_key")).agg(
        F.min("doc_id").alias("_id"), (F.count(F.lit(1)) > 1).alias("_copied"))


def _beside_texts(docs: DataFrame, rows: DataFrame, how: str) -> DataFrame:
    """``docs`` and the rows with their text's key and id; copies of one text are spread by their ids."""
    keyed = docs.withColumn("_text", value_key())
    rows = rows.withColumnRenamed("_id", "_row_id")
    return keyed.join(rows, (keyed["_text"] == rows["_key"]) & keyed["doc_id"].eqNullSafe(rows["_row_id"]), how)


def _windows_of(settings: Settings, segment: bytes, n: int) -> np.ndarray:
    sums = prefix_sums(np.frombuffer(segment, dtype=np.uint8))
    at = np.arange(n)
    return range_hashes(sums, at, at + settings.threshold)


def _spans_of(hits: np.ndarray, first: int, settings: Settings) -> list[tuple[int, int]]:
    """Byte spans (end exclusive) that the marked windows cover; neighbours are merged."""
    at = np.flatnonzero(hits)
    if not len(at):
        return []
    breaks = np.flatnonzero(np.diff(at) > settings.threshold)
    starts, ends = at[np.append(0, breaks + 1)], at[np.append(breaks, len(at) - 1)]
    return [(first + int(a), first + int(z) + settings.threshold) for a, z in zip(starts, ends)]


def spans(docs: DataFrame, settings: Settings = Settings(), keys: DataFrame | None = None) -> DataFrame:
    """_key, low, high: byte spans of texts that are repeated in another text or place."""
    keys = cut(_keys(docs)) if keys is None else keys
    per_text = cut(_runs(docs, settings))
    every = per_text.select("_key", F.inline(F.arrays_zip("gram", "context", "first", "n")))
    often = every.groupBy("gram").agg(F.count(F.lit(1)).alias("_n")).where("_n > 1")
    rows = cut(every.join(often, "gram", "left_semi"))
    forget(per_text)
    place = F.xxhash64("_key", "first")
    contexts = cut(rows.groupBy("gram", "context").agg(
        (F.min(place) != F.max(place)).alias("done"),
        *[F.first(c).alias(c) for c in ("_key", "first", "n")]))
    whole = rows.join(contexts.where("done"), ["gram", "context"], "left_semi").select(
        "_key", F.col("first").cast("long").alias("low"),
        (F.col("first") + F.col("n") - 1 + settings.threshold).cast("long").alias("high"))

    kinds = contexts.groupBy("gram").agg(F.count(F.lit(1)).alias("_kinds")).where("_kinds > 1")
    open_runs = contexts.join(kinds, "gram").select(
        "gram", "done", (F.col("_kinds") > settings.group).alias("large"), "_key", "first", "n")
    wanted = open_runs.groupBy("_key").agg(F.collect_list(F.struct("gram", "done", "large", "first", "n")).alias("_runs"))
    # One row of each text is enough; its id picks it without moving copies.
    found = _beside_texts(docs.select("doc_id", "text"), wanted.join(keys.select("_key", "_id"), "_key"), "inner")

    def segments(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for frame in frames:
            out = []
            for key, text, those in zip(frame["_key"], frame["text"], frame["_runs"]):
                data = utf8(text)
                for r in those:
                    segment = data[r["first"] : r["first"] + r["n"] - 1 + settings.threshold]
                    out.append((r["gram"], r["done"], r["large"], key, r["first"], r["n"], segment))
            if out:
                yield pd.DataFrame(out, columns=["gram", "done", "large", "_key", "first", "n", "segment"])

    shape = "gram long, done boolean, large boolean, _key long, first int, n int"
    # Written once: the groups of either size read it, and texts are shuffled a single time.
    brought = stored(found.select("_key", "text", "_runs").mapInPandas(segments, f"{shape}, segment binary"))

    def compare(groups: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        """Sorted by gram: groups are cut out of the stream, the last one waits for its rest."""
        held: list[pd.DataFrame] = []

        def told(frame: pd.DataFrame) -> list[tuple[int, int, int]]:
            out = []
            bounds = np.flatnonzero(np.append(True, np.diff(frame["gram"].to_numpy()) != 0))
            for a, z in zip(bounds, np.append(bounds[1:], len(frame))):
                part = frame.iloc[a:z].drop_duplicates(["_key", "first"])
                windows = [_windows_of(settings, s, n) for s, n in zip(part["segment"], part["n"])]
                values, back, counts = np.unique(np.concatenate(windows), return_inverse=True, return_counts=True)
                repeated, at = counts[back] > 1, 0
                for key, first, n, done in zip(part["_key"], part["first"], part["n"], part["done"]):
                    if not done:
                        out.extend((key, *s) for s in _spans_of(repeated[at : at + n], first, settings))
                    at += n
            return out

        for frame in groups:
            if not len(frame):
                continue
            gram = frame["gram"].to_numpy()
            cut_at = int(np.searchsorted(gram, gram[-1]))
            if held and held[-1]["gram"].iloc[0] == gram[-1] and cut_at == 0:
                held.append(frame)
                continue
            ready = pd.concat([*held, frame.iloc[:cut_at]])
            held = [frame.iloc[cut_at:]]
            yield pd.DataFrame(told(ready), columns=["_key", "low", "high"])
        if held:
            yield pd.DataFrame(told(pd.concat(held)), columns=["_key", "low", "high"])

    def rows_of(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        """Windows that a batch has in two places, as spans, and one place of each window for the others.

        So a window that very many texts have leaves a batch as one row.
        """
        for frame in frames:
            frame = frame.drop_duplicates(["_key", "first"])
            if not len(frame):
                continue
            n = frame["n"].to_numpy()
            window = np.concatenate([_windows_of(settings, s, k) for s, k in zip(frame["segment"], n)])
            ends = np.cumsum(n)
            low = np.repeat(frame["first"].to_numpy(np.int64) - (ends - n), n) + np.arange(len(window))
            values, place, back, counts = np.unique(window, return_index=True, return_inverse=True, return_counts=True)
            repeated = counts[back] > 1
            spans = [
                (key, *s) for key, first, z, k in zip(frame["_key"], frame["first"], ends, n)
                for s in _spans_of(repeated[z - k : z], int(first), settings)]
            yield pd.DataFrame({
                "window": values.view(np.int64), "_key": np.repeat(frame["_key"].to_numpy(), n)[place], "low": low[place],
                "high": np.full(len(values), -1)})
            if spans:
                key, low, high = zip(*spans)
                yield pd.DataFrame({"window": 0, "_key": key, "low": low, "high": high})

    def in_two(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        """Sorted by window: the rows whose window another row has at another place."""
        held: tuple | None = None
        told = True
        for frame in frames:
            if not len(frame):
                continue
            window, key, low = (frame[c].to_numpy() for c in ("window", "_key", "low"))
            if held is not None:
                window, key, low = (np.append(x, y) for x, y in zip(held, (window, key, low)))
            start = np.append(True, window[1:] != window[:-1])
            run = np.cumsum(start) - 1
            first = np.flatnonzero(start)
            other = (key != key[first][run]) | (low != low[first][run])
            several = np.logical_or.reduceat(other, first)
            if held is not None and told:
                several[0] = True
            mark = several[run]
            if held is not None and told:
                mark[0] = False
            yield pd.DataFrame({"_key": key[mark], "low": low[mark], "high": low[mark] + settings.threshold})
            at = first[-1]
            held, told = (window[at : at + 1], key[at : at + 1], low[at : at + 1]), bool(several[-1])

    small = brought.where("NOT large").repartition("gram").sortWithinPartitions("gram").mapInPandas(
        compare, "_key long, low long, high long")
    if not kinds.where(F.col("_kinds") > settings.group).limit(1).count():
        return whole.union(small)
    single = stored(brought.where("large").mapInPandas(rows_of, "window long, _key long, low long, high long"))
    beside = single.where("high < 0").select("window", "_key", "low").repartition("window").sortWithinPartitions(
        "window", "_key", "low").mapInPandas(in_two, "_key long, low long, high long")
    return whole.union(small).union(single.where("high >= 0").select("_key", "low", "high")).union(beside)


def remove_repeated(docs: DataFrame, settings: Settings = Settings()) -> DataFrame:
    """``docs`` with n_bytes, n_removed, n_spans, kept (binary) and kept_sha256."""
    added = ("n_bytes", "n_removed", "n_spans", "kept", "kept_sha256")
    keys = cut(_keys(docs))
    copied = docs.select("doc_id", value_key().alias("_key")).distinct().join(
        keys.where("_copied").select("_key"), "_key").select(
        "_key", F.col("doc_id").alias("_id"), F.lit(True).alias("_copied"))
    # A text of two rows goes as a whole, so only the others need their spans.
    per_text = spans(docs, settings, keys).groupBy("_key").agg(F.collect_set(F.struct("low", "high")).alias("_spans"))
    single = per_text.join(keys.where("NOT _copied").select("_key", "_id"), "_key")
    marks = single.unionByName(copied, allowMissingColumns=True)

    @F.pandas_udf("removed long, spans long, kept binary")
    def removed(texts: pd.Series, lists: pd.Series) -> pd.DataFrame:
        out = []
        for text, those in zip(texts, lists):
            if text is None or those is None:
                out.append((0, 0, None))
                continue
            data = np.frombuffer(utf8(text), dtype=np.uint8)
            step = np.zeros(len(data) + 1, dtype=np.int64)
            for s in those:
                step[s["low"]] += 1
                step[s["high"]] -= 1
            gone = np.cumsum(step[:-1]) > 0
            edges = np.count_nonzero(np.diff(np.append(False, gone).astype(np.int8)) > 0)
            out.append((int(gone.sum()), int(edges), data[~gone].tobytes()))
        return pd.DataFrame(out, columns=["removed", "spans", "kept"])

    base = without(docs, *added)
    joined = _beside_texts(base, marks, "left")
    text = F.coalesce("text", F.lit(""))
    size = F.octet_length(text).cast("long")
    all_gone = F.coalesce("_copied", F.lit(False)) & (size >= settings.threshold)
    some = F.col("_spans").isNotNull() & ~all_gone
    done = joined.withColumn("_cut", removed(F.when(some, text), F.when(some, F.col("_spans"))))
    kept = F.when(all_gone, F.lit(b"")).when(some, F.col("_cut.kept")).otherwise(text.cast("binary"))
    return done.select(
        *base.columns, size.alias("n_bytes"),
        F.when(all_gone, size).otherwise(F.col("_cut.removed")).alias("n_removed"),
        F.when(all_gone, F.lit(1)).otherwise(F.col("_cut.spans")).cast("long").alias("n_spans"),
        kept.alias("kept"), F.sha2(kept, 256).alias("kept_sha256"))


def sha256(data: bytes) -> str:
    return hashlib.sha256(data).hexdigest()
