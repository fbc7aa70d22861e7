"""Personal data by bootstrapped contextual extraction, with DataFrame functions only.

Base spans come from fixed patterns; they are the seeds. Loose patterns of the same kinds give
more candidates (obfuscated addresses, numbers with other separators). Every candidate, seed or
not, has lexical patterns around it: the two words before it, the word before it, and the word
behind it. Patterns and instances (candidate texts) form a graph per kind that is scored in
``rounds`` rounds of two aggregates each: a pattern's confidence is the mean score of its distinct
instances, shrunk by ``prior`` and zero below ``support`` different seeds; an instance that is no
seed scores what its patterns say together, ``1 - product(1 - confidence)``. Instances of at least
``accept`` are added where they don't overlap a base span or an earlier added one.

Patterns are matched once: ``split`` gives the text between the matches of a pattern and
``regexp_extract_all`` the matches, and running lengths give the places in code points. Texts
without the characters of a kind skip its pattern. Graph edges are combined before they are
shuffled, by kind, pattern and instance, so a context that very many texts share costs one row
per task and instance. What is found in a text depends on the text alone and is keyed by its hash.

Defined results: NULL counts as empty; repeated rows get the same spans; an empty table gives an
empty result; extra columns are ignored.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from kpiloom.llm.common import SPACE_CLASS, cut, value_key

KINDS = ("email", "ip", "card", "phone")

# A match starts where no character of its first class stands before it, or right behind the
# last match; possessive loops take what no shorter match could use.
BASE = {
    "email": r"(?:\G|(?<![A-Za-z0-9._%+-]))[A-Za-z0-9._%+-]++@[A-Za-z0-9-]++(?:\.[A-Za-z0-9-]++)++",
    "ip": r"(?:\G|(?<![0-9]))[0-9]++(?:\.[0-9]++){3}",
    "card": r"[0-9](?:[\x20-]?[0-9])++",
    "phone": r"\+[0-9][\x20().0-9-]+[0-9]",
}
# Cheap tests that a text can hold a match at all.
MAYBE = {
    "email": r"@[A-Za-z0-9-]+\.",
    "ip": r"[0-9]\.[0-9]++\.[0-9]",
    "card": r"[0-9](?:[\x20-]?[0-9]){13}",
    "phone": r"\+[0-9]",
}
LOOSE = {
    "email": r"(?<![A-Za-z0-9._%+-])[A-Za-z0-9._%+-]{1,64}+(?:\x20?[(\[{](?:at|AT)[)\]}]\x20?|\x20(?:at|AT)\x20|@)"
             r"[A-Za-z0-9-]{1,63}+(?:(?:\x20?[(\[{](?:dot|DOT)[)\]}]\x20?|\x20(?:dot|DOT)\x20|\.)[A-Za-z0-9-]{1,63}+){1,8}+",
    "ip": r"(?<![0-9.])[0-9]{1,3}(?:(?:\x20?[(\[{](?:dot|DOT|\.)[)\]}]\x20?|[,_:])[0-9]{1,3}){3}(?![0-9])",
    "card": r"(?<![0-9])[0-9]{4}[._/:][0-9]{4}[._/:][0-9]{4}[._/:][0-9]{2,7}(?![0-9])",
    "phone": r"(?<![0-9+])(?:00[0-9]{1,3}[\x20./-]?)?\(?[0-9]{3}\)?[\x20./-][0-9]{3}[\x20./-][0-9]{4}(?![0-9])",
}
LOOSE_MAYBE = {
    "email": r"[(\[{](?:at|AT)[)\]}]|\x20(?:dot|DOT)\x20|[(\[{](?:dot|DOT)[)\]}]",
    "ip": r"[0-9][,_:][0-9]{1,3}[,_:][0-9]|[0-9]\x20?[(\[{](?:dot|DOT|\.)",
    "card": r"[0-9]{4}[._/:][0-9]{4}[._/:]",
    "phone": r"[0-9]{3}\)?[\x20./-][0-9]{3}[\x20./-][0-9]{4}",
}
_OCTET = r"0*(?:25[0-5]|2[0-4][0-9]|1?[0-9]{1,2})"


@dataclass(frozen=True)
class Settings:
    rounds: int = 3
    support: int = 3
    prior: float = 1.0
    accept: float = 0.75


def _luhn(digits: Column) -> Column:
    """Sum of the digits from the right, every second one doubled, divisible by ten."""
    n = F.length(digits)
    at = F.transform(F.sequence(F.lit(1), n), lambda i: F.substring(digits, i, F.lit(1)).cast("int") * F.when((n - i) % 2 == 1, 2).otherwise(1))
    return F.aggregate(at, F.lit(0), lambda a, d: a + d - F.when(d > 9, 9).otherwise(0)) % 10 == 0


def _valid(kind: str, match: Column) -> Column:
    digits = F.regexp_replace(match, "[^0-9]", "")
    if kind == "ip":
        return match.rlike(rf"^{_OCTET}(?:\.{_OCTET}){{3}}$")
    if kind == "card":
        return F.when(F.length(digits).between(14, 19), _luhn(digits)).otherwise(False)
    if kind == "phone":
        return F.length(digits).between(10, 15)
    return F.lit(True)


def _spans(kind: str, pattern: str, maybe: str, valid: bool) -> Column:
    """Array of (start, end, kind number, match) for the pattern's matches in ``_text``."""
    text = F.col("_text")
    gaps = F.transform(F.split(text, pattern, -1), lambda g: F.length(g))
    pairs = F.zip_with(gaps, F.regexp_extract_all(text, F.lit(pattern), F.lit(0)), lambda g, m: F.struct(g.alias("g"), m.alias("m")))
    shape = "array<struct<start:int,end:int,kind:int,match:string>>"
    empty = F.array().cast(shape)
    first = F.struct(F.lit(0).alias("at"), empty.alias("out"))
    number = F.lit(KINDS.index(kind))

    def step(a: Column, p: Column) -> Column:
        start = a["at"] + p["g"]
        end = start + F.length(p["m"])
        one = F.array(F.struct(start.alias("start"), end.alias("end"), number.alias("kind"), p["m"].alias("match")))
        return F.when(p["m"].isNull(), a).otherwise(F.struct(end.alias("at"), F.concat(a["out"], one).alias("out")))

    found = F.aggregate(pairs, first, step, lambda a: a["out"])
    if valid and kind != "email":
        found = F.filter(found, lambda s: _valid(kind, s["match"]))
    return F.when(text.rlike(maybe), found).otherwise(empty)


def _ordered(spans: Column) -> Column:
    """By start, then kind as listed."""
    keyed = F.transform(spans, lambda s: F.struct(s["start"].alias("start"), s["kind"].alias("kind"), s["end"].alias("end")))
    return F.array_sort(keyed)


def _written(spans: Column) -> Column:
    names = F.array(*[F.lit(k) for k in KINDS])
    return F.array_join(F.transform(spans, lambda s: F.concat_ws(
        ":", F.get(names, s["kind"]), s["start"].cast("string"), s["end"].cast("string"))), ",")


def base_spans(docs: DataFrame) -> DataFrame:
    """doc_id, _key, base (ordered spans), loose (candidates that are no base spans), contexts of both."""
    texts = docs.select("doc_id", value_key().alias("_key"), F.coalesce("text", F.lit("")).alias("_text"))
    kinds = texts.select("*", *[_spans(k, BASE[k], MAYBE[k], True).alias(f"_{k}") for k in KINDS])
    both = kinds.select(
        "doc_id", "_key", "_text", F.concat(*[F.col(f"_{k}") for k in KINDS]).alias("_base"),
        F.concat(*[_spans(k, LOOSE[k], LOOSE_MAYBE[k], False) for k in KINDS]).alias("_loose"))
    # A loose candidate must not touch a base span.
    free = F.filter("_loose", lambda s: ~F.exists("_base", lambda b: (b["start"] < s["end"]) & (s["start"] < b["end"])))
    return both.select("doc_id", "_key", "_text", "_base", free.alias("_free"))


def _contexts(candidates: DataFrame) -> DataFrame:
    """One row per (candidate, pattern): _key, kind, instance, seed, start, end, pattern."""
    word = SPACE_CLASS + "+"
    near = F.lower(F.substring("_text", F.greatest(F.col("s.start") - 79, F.lit(1)), F.least(F.col("s.start"), F.lit(80))))
    # Characters of the text start at 1, places at 0: the part before a span ends at its start.
    before = F.filter(F.split(near, word), lambda w: w != "")
    after = F.filter(F.split(F.lower(F.substring("_text", F.col("s.end") + 1, F.lit(80))), word), lambda w: w != "")
    rows = candidates.select(
        "_key", "seed", F.col("s.kind").alias("kind"), F.col("s.start").alias("start"), F.col("s.end").alias("end"),
        F.lower("s.match").alias("instance"), before.alias("b"), after.alias("a"))
    last, one = F.try_element_at("b", F.lit(-1)), F.try_element_at("b", F.lit(-2))
    patterns = F.array(
        F.concat(F.lit("2 "), one, F.lit(" "), last), F.concat(F.lit("1 "), last),
        F.concat(F.lit("3 "), F.try_element_at("a", F.lit(1))))
    return rows.select("_key", "seed", "kind", "instance", "start", "end", F.explode(F.filter(patterns, lambda p: p.isNotNull())).alias("pattern"))


def discovered(found: DataFrame, settings: Settings = Settings()) -> DataFrame:
    """_key, start, end, kind of candidates that confident patterns confirm."""
    some = found.where((F.size("_free") > 0) | (F.size("_base") > 0))
    tagged = some.select("_key", "_text", F.explode(F.concat(
        F.transform("_base", lambda s: F.struct(s.alias("s"), F.lit(True).alias("seed"))),
        F.transform("_free", lambda s: F.struct(s.alias("s"), F.lit(False).alias("seed"))))).alias("_one"))
    rows = cut(_contexts(tagged.select("_key", "_text", "_one.s", "_one.seed")))
    # A text that is a base span anywhere is a seed everywhere.
    edges = cut(rows.groupBy("kind", "pattern", "instance").agg(F.max("seed").alias("seed")))
    scores = edges.groupBy("kind", "instance").agg(F.max(F.col("seed").cast("double")).alias("score"))
    for _ in range(settings.rounds):
        held = edges.select("kind", "pattern", "instance").join(scores, ["kind", "instance"])
        confidence = held.groupBy("kind", "pattern").agg(
            F.sum("score").alias("_sum"), F.count(F.lit(1)).alias("_n"),
            F.count(F.when(F.col("score") >= 1, 1)).alias("_seeds")).select(
            "kind", "pattern", F.when(F.col("_seeds") >= settings.support, F.col("_sum") / (F.col("_n") + settings.prior)).otherwise(0.0).alias("confidence"))
        miss = F.sum(F.log(F.greatest(1 - F.col("confidence"), F.lit(1e-9))))
        scores = cut(
            held.join(confidence, ["kind", "pattern"]).groupBy("kind", "instance").agg(
                F.max("score").alias("_old"), miss.alias("_miss"))
            .select("kind", "instance", F.when(F.col("_old") >= 1, 1.0).otherwise(
                F.least(F.lit(0.999), 1 - F.exp("_miss"))).alias("score")))
    sure = scores.where(F.col("score") >= settings.accept).select("kind", "instance")
    return rows.where("NOT seed").select("_key", "start", "end", "kind", "instance").distinct().join(
        sure, ["kind", "instance"], "left_semi").select("_key", "start", "end", "kind")


def _count(kind: int) -> Column:
    return F.size(F.filter("_base", lambda s: s["kind"] == kind)).cast("long")


def find(docs: DataFrame, settings: Settings = Settings()) -> DataFrame:
    """doc_id, n_<kind> (base spans), base_sha256, spans (base and discovered ones, as text)."""
    found = base_spans(docs)
    # Texts without any candidate are not needed again; of the others the spans and the text stay.
    slim = cut(found.select(
        "doc_id", "_key", F.when((F.size("_free") > 0) | (F.size("_base") > 0), F.col("_text")).alias("_text"), "_base", "_free"))
    added = discovered(slim, settings).groupBy("_key").agg(F.collect_set(F.struct("start", "kind", "end")).alias("_added"))
    base = _ordered(F.col("_base"))
    joined = slim.drop("_text", "_free").join(added, "_key", "left")
    # Added spans in order; one that overlaps an earlier added one is left out.
    shape = "array<struct<start:int,kind:int,end:int>>"
    first = F.struct(F.lit(0).alias("at"), F.array().cast(shape).alias("out"))
    apart = F.aggregate(
        F.array_sort(F.coalesce("_added", F.array().cast(shape))), first,
        lambda a, s: F.when(s["start"] < a["at"], a).otherwise(
            F.struct(s["end"].alias("at"), F.concat(a["out"], F.array(s)).alias("out"))),
        lambda a: a["out"])
    ready = joined.select("doc_id", "_base", base.alias("_b"), apart.alias("_more"))
    return ready.select(
        "doc_id",
        *[_count(i).alias(f"n_{k}") for i, k in enumerate(KINDS)],
        F.sha2(_written(F.col("_b")), 256).alias("base_sha256"),
        _written(F.array_sort(F.concat("_b", "_more"))).alias("spans"))
