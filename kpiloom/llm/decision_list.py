"""Quality rules as a learned decision list, with DataFrame functions only.

Statistics of a text are array and regular-expression functions. Rules that reject are learned
one after another from labelled rows (sequential covering): a rule grows by the threshold
condition with the best information gain on two thirds of the rows that no earlier rule covers,
up to ``conditions`` conditions or until it covers no good row, and is then cut back to the
length that does best on the other third. Learning stops when a rule is not precise enough there,
or at ``rules`` rules. Each step is one aggregate over the labelled rows, by statistic and bin;
the driver sees at most ``bins`` counts for each statistic. The list is an ordered conditional
expression: the first rule that holds rejects, and a text that none rejects is kept.

Defined results: NULL counts as empty; a text without words has zero in every statistic and
fails the base rule; without labels the list is empty and the base rule decides alone; repeated
rows are scored alike; an empty table gives an empty result; extra columns are ignored.
"""

from __future__ import annotations

import math
from dataclasses import dataclass, field

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from kpiloom.llm.common import SPACE_CLASS, SPACES, WORD_CLASS, cut


@dataclass(frozen=True)
class Settings:
    bins: int = 64
    rules: int = 12
    conditions: int = 3
    precision: float = 0.95
    least: int = 5
    window: int = 5


@dataclass(frozen=True)
class Condition:
    statistic: str
    above: bool
    threshold: float

    def column(self) -> Column:
        value = F.col(self.statistic)
        return value > self.threshold if self.above else value <= self.threshold


@dataclass(frozen=True)
class Rule:
    conditions: tuple[Condition, ...]
    bad: int = field(default=0, compare=False)
    good: int = field(default=0, compare=False)

    def column(self) -> Column:
        out = F.lit(True)
        for c in self.conditions:
            out = out & c.column()
        return out


#: Learnable statistics: name -> (numerator, denominator) of the counted columns.
RATIOS = {
    "symbol_share": ("n_symbols", "word_chars"),
    "mark_share": ("n_marks", "word_chars"),
    "capital_share": ("n_capitals", "word_chars"),
    "digit_share": ("n_digits", "word_chars"),
    "word_length": ("word_chars", "n_words"),
    "end_share": ("n_ends", "n_words"),
    "distinct_share": ("n_distinct", "n_words"),
    "repeat_share": ("n_repeat_words", "n_words"),
    "dup_line_share": ("n_dup_lines", "n_lines"),
    "line_words": ("n_words", "n_lines"),
    "words": ("n_words", None),
}


def _repeat_words(size: int) -> Column:
    """Words inside windows that occur twice or more; ``_windows`` holds the window hashes.

    Sorted by (hash, place), equal windows are neighbours. Their places in order, each covering
    ``size`` words, are added up without double counting.
    """
    ordered = F.transform(F.array("_sorted"), lambda s: F.array_sort(F.filter(F.transform(
        s, lambda x, i: F.when(
            (F.get(s, i - 1)["h"] == x["h"]) | (F.get(s, i + 1)["h"] == x["h"]), x["i"])),
        lambda p: p.isNotNull())))[0]
    start = F.struct(F.lit(0).cast("int").alias("end"), F.lit(0).cast("int").alias("n"))
    return F.aggregate(
        ordered, start,
        lambda a, p: F.struct((p + size).alias("end"), (a["n"] + p + size - F.greatest(p, a["end"])).alias("n")),
        lambda a: a["n"])


def statistics(docs: DataFrame, settings: Settings = Settings()) -> DataFrame:
    """doc_id, the counted columns (long) and the learnable statistics (double)."""
    k = settings.window
    text = F.coalesce(F.col("text"), F.lit(""))
    bare = F.btrim(text, F.lit(SPACES))
    words = docs.select("doc_id", text.alias("_text"), F.when(bare == "", F.array().cast("array<string>")).otherwise(
        F.split(bare, SPACE_CLASS + "+")).alias("_words"))
    lines = F.filter(F.split("_text", "\n"), lambda x: x.rlike(WORD_CLASS))
    hashed = words.select(
        "doc_id", "_text", F.size("_words").alias("n_words"), F.length(F.array_join("_words", "")).alias("word_chars"),
        F.transform("_words", lambda w: F.xxhash64(w)).alias("_hashes"), lines.alias("_lines"))
    h = F.col("_hashes")
    windows = F.when(F.col("n_words") >= k, F.transform(
        F.sequence(F.lit(0), F.col("n_words") - k), lambda i: F.xxhash64(*[F.get(h, i + j) for j in range(k)]))
    ).otherwise(F.array().cast("array<bigint>"))
    counted = hashed.select(
        "doc_id", "n_words", "word_chars", windows.alias("_windows"),
        F.regexp_count("_text", F.lit(r"[#*$%&|<>]")).alias("n_symbols"),
        F.regexp_count("_text", F.lit(r"[!?=~^_{}\[\]\\/@+]")).alias("n_marks"),
        F.regexp_count("_text", F.lit(r"\p{Lu}")).alias("n_capitals"),
        F.regexp_count("_text", F.lit(r"[0-9]")).alias("n_digits"),
        F.regexp_count("_text", F.lit(rf"[.?!](?={SPACE_CLASS}|$)")).alias("n_ends"),
        F.size(F.array_distinct(h)).alias("n_distinct"),
        F.size("_lines").alias("n_lines"),
        (F.size("_lines") - F.size(F.array_distinct("_lines"))).alias("n_dup_lines"))
    # Only texts in which a window comes twice are sorted.
    twice = F.size(F.array_distinct("_windows")) < F.size("_windows")
    placed = counted.withColumn("_sorted", F.when(twice, F.array_sort(F.transform(
        "_windows", lambda x, i: F.struct(x.alias("h"), i.alias("i"))))))
    repeated = placed.withColumn("n_repeat_words", F.when(F.col("_sorted").isNull(), 0).otherwise(_repeat_words(k)))
    names = ["n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "n_marks", "n_capitals",
             "n_digits", "n_ends", "n_distinct", "n_lines"]
    full = repeated.select("doc_id", *[F.col(n).cast("long").alias(n) for n in names])
    return full.select("*", *[
        (F.when(F.col(b) > 0, F.col(a) / F.col(b)).otherwise(0.0) if b else F.col(a).cast("double")).alias(name)
        for name, (a, b) in RATIOS.items()])


def _held_out(doc_id: Column) -> Column:
    return F.crc32(F.coalesce(doc_id.cast("string"), F.lit(""))) % 5 == 0


def _gain(bad: int, good: int, bad_before: int, good_before: int) -> float:
    """Information gain of a refinement, weighted by the bad rows that it keeps."""
    if not bad:
        return 0.0
    return bad * (math.log2(bad / (bad + good)) - math.log2(bad_before / (bad_before + good_before)))


def _bin(name: str, edges: list[float]) -> Column:
    """How many edges lie below the value."""
    return F.size(F.filter(F.array(*[F.lit(float(e)) for e in edges]).cast("array<double>"), lambda e: F.col(name) > e))


def learn(stats: DataFrame, labels: DataFrame, settings: Settings = Settings()) -> list[Rule]:
    """Ordered rules that reject; ``labels``: doc_id, quality (1 good, 0 bad).

    NULL labels and ids are ignored, of contradicting labels the larger counts, and the rows of
    the held-out fifth are not used.
    """
    named = (
        labels.where("quality IS NOT NULL AND doc_id IS NOT NULL").where(~_held_out(F.col("doc_id")))
        .groupBy("doc_id").agg(F.max("quality").alias("_good")))
    names = list(RATIOS)
    rows = cut(stats.join(named, "doc_id").select(
        "doc_id", (F.col("_good") > 0).alias("_good"), *names,
        (F.pmod(F.xxhash64("doc_id", F.lit("grow")), F.lit(3)) > 0).alias("_grow")))
    shares = [i / settings.bins for i in range(1, settings.bins)]
    # Thresholds come from the bad rows and from all rows: junk may sit in a narrow range.
    found = rows.agg(
        *[F.percentile_approx(n, shares, 2000).alias(f"{n}_all") for n in names],
        *[F.percentile_approx(F.when(~F.col("_good"), F.col(n)), shares, 2000).alias(f"{n}_bad") for n in names]).first()
    cuts = {n: sorted({*(found[f"{n}_all"] or []), *(found[f"{n}_bad"] or [])}) for n in names}
    rules: list[Rule] = []
    left = rows

    def counts(of: DataFrame, condition: Column) -> tuple[int, int]:
        got = of.where(condition).agg(F.count(F.when(~F.col("_good"), 1)), F.count(F.when(F.col("_good"), 1))).first()
        return int(got[0]), int(got[1])

    while len(rules) < settings.rules:
        conditions: list[Condition] = []
        inside = left.where("_grow")
        while len(conditions) < settings.conditions:
            table = inside.select("_good", F.explode(F.array(*[
                F.struct(F.lit(n).alias("name"), _bin(n, cuts[n]).alias("bin")) for n in names])).alias("_at")).groupBy("_at.name", "_at.bin").agg(
                    F.count(F.when(~F.col("_good"), 1)).alias("bad"), F.count(F.when(F.col("_good"), 1)).alias("good")).collect()
            best, total = (0.0, None, 0, 0), (0, 0)
            for n in names:
                mine = {r["bin"]: (r["bad"], r["good"]) for r in table if r["name"] == n}
                total = tuple(sum(v[i] for v in mine.values()) for i in (0, 1))
                low = [0, 0]
                for b, edge in enumerate(cuts[n]):
                    low = [low[i] + mine.get(b, (0, 0))[i] for i in (0, 1)]
                    for above, (bad, good) in ((False, low), (True, (total[0] - low[0], total[1] - low[1]))):
                        gain = _gain(bad, good, *total)
                        if gain > best[0] + 1e-9:
                            best = (gain, Condition(n, above, float(edge)), bad, good)
            if best[1] is None or total[0] < settings.least:
                break
            conditions.append(best[1])
            inside = inside.where(best[1].column())
            if best[3] == 0:
                break
        if not conditions:
            break
        # One aggregate weighs every length of the rule on the rows kept for pruning.
        tests, until = [], F.lit(True)
        for c in conditions:
            until = until & c.column()
            tests += [F.count(F.when(until & ~F.col("_good"), 1)), F.count(F.when(until & F.col("_good"), 1))]
        got = left.where("NOT _grow").agg(*tests).first()
        worth = [(got[2 * i] - got[2 * i + 1]) / (got[2 * i] + got[2 * i + 1]) if got[2 * i] + got[2 * i + 1] else -1.0
                 for i in range(len(conditions))]
        length = max(range(len(conditions)), key=lambda i: (worth[i], -i)) + 1
        bad, good = got[2 * length - 2], got[2 * length - 1]
        if bad < settings.least or bad < settings.precision * (bad + good):
            break
        rule = Rule(tuple(conditions[:length]), bad, good)
        rules.append(rule)
        left = left.where(~rule.column())
    return rules


def verdict(rules: list[Rule]) -> Column:
    """True unless one of the ordered rules rejects."""
    out = None
    for rule in rules:
        out = F.when(rule.column(), False) if out is None else out.when(rule.column(), False)
    return F.lit(True) if out is None else out.otherwise(True)


def judge(docs: DataFrame, labels: DataFrame, settings: Settings = Settings()) -> tuple[DataFrame, list[Rule]]:
    """Statistics with base_failed and kept, and the rules behind kept."""
    stats = cut(statistics(docs, settings))
    rules = learn(stats, labels, settings)
    failed = (F.col("n_words") < 10) | (100 * F.col("n_repeat_words") > 20 * F.col("n_words"))
    return stats.withColumn("base_failed", failed).withColumn("kept", ~failed & verdict(rules)), rules
