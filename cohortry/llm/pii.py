"""Personal data: base patterns with their checks, and candidates selected by boosted trees."""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass, field

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from cohortry.llm.boosting import Tree, boost, probability
from cohortry.llm.common import staged, table

KINDS = ["email", "ip", "card", "phone"]
#: Base patterns. The starts only spare attempts that must fail: within a run of characters that a match begins with,
#: the leftmost match starts where the run or the rest of it starts. Repeated groups are possessive: nothing stands after
#: them, and so a value of any length takes no stack.
BASE = {
    "email": r"(?:\G|(?<![A-Za-z0-9._%+-]))[A-Za-z0-9._%+-]++@[A-Za-z0-9-]++(?:\.[A-Za-z0-9-]++)++",
    "ip": r"(?:\G|(?<![0-9]))[0-9]++\.[0-9]++\.[0-9]++\.[0-9]++",
    "card": r"[0-9](?:[\x20-]?[0-9])++",
    "phone": r"\+[0-9][\x20().0-9-]+[0-9]",
}
#: High-recall generators: name, kind that they propose, pattern. Their spans may overlap, also those of one kind.
GENERATORS = [
    ("mail", "email", r"(?:\G|(?<![^\s@(\[]))[^\s@(\[]++\x20?+(?:@|\(at\)|\[at\])\x20?+[^\s@(\[]++(?:\x20?+(?:\(dot\)|\[dot\])\x20?+[^\s@(\[]++)*+"),
    ("dotted", "ip", r"(?<![0-9.])[0-9]++(?:\[?+[.,:]\]?+[0-9]++){2,}+"),
    ("figures", "card", r"(?<![0-9])[0-9](?:[\x20._/-]{0,2}+[0-9]){11,}+"),
    ("fours", "card", r"(?<![0-9])[0-9]{4}(?:[\x20._/-]{0,2}+[0-9]{4}){2}[\x20._/-]{0,2}+[0-9]{1,7}+(?![0-9])"),
    ("numbers", "phone", r"[+(]?(?<![0-9])[0-9](?:[\x20()./-]{0,3}+[0-9]){6,}+"),
    ("parts", "phone", r"(?<![0-9])(?:\+?[0-9]{1,3}[\x20./-]{1,3}+)?\(?[0-9]{2,4}\)?[\x20./-]{1,3}+[0-9]{3,4}[\x20./-]{1,3}+[0-9]{3,4}(?![0-9])"),
]
#: Characters that a text must have for a pattern to be tried.
NEEDS = {"email": r"@|at[)\]]", "ip": r"[0-9]\[?[.,:]", "card": "[0-9]", "phone": "[0-9]"}
FEATURES = ["kind", "length", "digits", "letters", "dots", "spaces", "dashes", "brackets", "others", "longest_digits", "groups", "luhn", "octets", "left", "right"]
#: Forms that the base patterns miss, by kind: (pattern, replacement) in turn. Base spans of the texts that are fitted on are written
#: in one of these, or left as they are.
FORMS = {
    "email": [[("@", " (at) ")], [("@", "[at]")], [("@", " @ ")], [("@", "(at)"), (r"\.(?=[^.]*$)", " [dot] ")]],
    "ip": [[(r"\.", "[.]")], [(r"\.", ":")], [(r"\.", ",")]],
    "card": [[("[^0-9]", ""), ("([0-9]{4})(?=[0-9])", "$1.")], [("[^0-9]", ""), ("([0-9]{4})(?=[0-9])", "$1/")], [("[^0-9]", ""), ("([0-9]{4})(?=[0-9])", "$1  ")]],
    "phone": [[(r"^\+", "")], [(r"^\+[0-9]+[^0-9]+", "")], [(r"[^0-9]+", "."), (r"^\.", "")], [(r"[^0-9+]+", " / ")]],
}
ROUNDS = 12
#: Held-out candidates above a kind's threshold must be right this often, and be so many.
MIN_PRECISION, MIN_HELD_OUT = 0.98, 20

SPAN = "array<struct<start:int,end:int,value:string>>"


def matches(df: DataFrame, patterns: dict[str, tuple[str, str]], text: str, prefix: str) -> DataFrame:
    """Add ``prefix`` + name for each name: (needed, pattern): its leftmost non-overlapping matches as start, end, value, in
    code points. The pieces between matches give the places: each starts where the pieces and matches before it end.
    """
    t = F.col(text)
    df = df.withColumns({f"_f_{k}": F.when(t.rlike(need), F.regexp_extract_all(t, F.lit(p), F.lit(0))) for k, (need, p) in patterns.items()})
    df = df.withColumns({f"_p_{k}": F.when(F.size(f"_f_{k}") > 0, F.split(t, p, -1)) for k, (_, p) in patterns.items()})

    def placed(k: str) -> Column:
        def step(state: Column, i: Column) -> Column:
            value = F.element_at(f"_f_{k}", i)
            start = state["at"] + F.length(F.element_at(f"_p_{k}", i))
            end = start + F.length(value)
            return F.struct(end.alias("at"), F.concat(state["out"], F.array(F.struct(start.alias("start"), end.alias("end"), value.alias("value")))).alias("out"))

        none = F.array().cast(SPAN)
        found = F.aggregate(F.sequence(F.lit(1), F.size(f"_f_{k}")), F.struct(F.lit(0).alias("at"), none.alias("out")), step, lambda s: s["out"])
        return F.when(F.size(f"_f_{k}") > 0, found).otherwise(none)

    df = df.withColumns({prefix + k: placed(k) for k in patterns})
    return df.drop(*[f"_{x}_{k}" for k in patterns for x in "fp"])


def digits_of(value: Column) -> Column:
    return F.regexp_replace(value, "[^0-9]", "")


def luhn(value: Column) -> Column:
    """Whether the digits of a value pass the Luhn check."""
    figures = F.filter(F.split(F.reverse(digits_of(value)), ""), lambda c: c != "")
    doubled = lambda v: F.when(v > 4, 2 * v - 9).otherwise(2 * v)
    each = F.transform(figures, lambda c, i: F.when(i % 2 == 1, doubled(c.cast("int"))).otherwise(c.cast("int")))
    return (F.size(figures) > 0) & (F.aggregate(each, F.lit(0), lambda a, b: a + b) % 10 == 0)


def octets(value: Column) -> Column:
    """Whether all runs of digits of a value are at most 255."""
    return ~F.exists(F.split(F.regexp_replace(value, "(?<![0-9])0+(?=[0-9])", ""), "[^0-9]+"), lambda p: (F.length(p) > 3) | (F.coalesce(p.try_cast("int"), F.lit(0)) > 255))


def valid(kind: str, value: Column) -> Column:
    n = F.length(digits_of(value))
    return {"email": F.lit(True), "ip": octets(value), "card": (n >= 14) & (n <= 19) & luhn(value), "phone": (n >= 10) & (n <= 15)}[kind]


def base_spans(df: DataFrame, text: str) -> DataFrame:
    """Add ``base``: the checked base spans by start, then kind: start, kind (place in KINDS), end."""
    df = matches(df, {k: (NEEDS[k], p) for k, p in BASE.items()}, text, "_b_")

    def kept(i: int, k: str) -> Column:
        return F.transform(F.filter(f"_b_{k}", lambda m: valid(k, m["value"])), lambda m: F.struct(m["start"].alias("start"), F.lit(i).alias("kind"), m["end"].alias("end")))

    return df.withColumn("base", F.sort_array(F.concat(*[kept(i, k) for i, k in enumerate(KINDS)]))).drop(*[f"_b_{k}" for k in KINDS])


def candidates(df: DataFrame, text: str, known: str, wanted: Callable[[Column, int], Column] | None = None, kinds: list[int] | None = None) -> DataFrame:
    """Add ``found``: spans proposed by the generators (of ``kinds``), which may overlap, with format and context features,
    and ``label``: whether a span of the kind in ``known`` covers half of it and half of that span is covered. Only those
    that ``wanted`` accepts get features."""
    chosen = {name: (KINDS.index(kind), p) for name, kind, p in GENERATORS if kinds is None or KINDS.index(kind) in kinds}
    df = matches(df, {name: (NEEDS[KINDS[i]], p) for name, (i, p) in chosen.items()}, text, "_g_")
    t = F.col(text)

    def featured(i: int, m: Column) -> Column:
        v = m["value"]
        count = lambda chars: (F.length(v) - F.length(F.regexp_replace(v, chars, ""))).cast("double")
        side = lambda at: F.when(at < 1, 0.0).when(F.substring(t, at, F.lit(1)).rlike("[A-Za-z]"), 1.0).when(F.substring(t, at, F.lit(1)).rlike("[0-9]"), 2.0).when(F.substring(t, at, F.lit(1)).rlike(r"[\s]"), 3.0).when(F.substring(t, at, F.lit(1)) == "", 0.0).otherwise(4.0)
        groups = F.filter(F.split(v, "[^0-9]+"), lambda g: g != "")
        both = lambda b: F.least(b["end"], m["end"]) - F.greatest(b["start"], m["start"])
        shared = F.exists(known, lambda b: (b["kind"] == i) & (2 * both(b) >= m["end"] - m["start"]) & (2 * both(b) >= b["end"] - b["start"]))
        values = {
            "kind": F.lit(float(i)), "length": F.length(v).cast("double"), "digits": count("[0-9]"), "letters": count("[A-Za-z]"), "dots": count("[.]"), "spaces": count(r"\s"), "dashes": count("[-_/]"),
            "brackets": count(r"[()\[\]]"), "others": count(r"[0-9A-Za-z.\s()/_\[\]@+-]") * -1 + F.length(v), "longest_digits": F.coalesce(F.array_max(F.transform(groups, F.length)), F.lit(0)).cast("double"),
            "groups": F.size(groups).cast("double"), "luhn": F.when(luhn(v), 1.0).otherwise(0.0), "octets": F.when(octets(v), 1.0).otherwise(0.0), "left": side(m["start"]), "right": side(m["end"] + 1),
        }
        return F.struct(m["start"].alias("start"), F.lit(i).alias("kind_at"), m["end"].alias("end"), F.when(shared, 1.0).otherwise(0.0).alias("label"), *[c.alias(f) for f, c in values.items()])

    def made(name: str) -> Column:
        i, proposed = chosen[name][0], F.col(f"_g_{name}")
        return F.transform(F.filter(proposed, lambda m: wanted(m, i)) if wanted else proposed, lambda m: featured(i, m))

    return df.withColumn("found", F.concat(*map(made, chosen))).drop(*[f"_g_{name}" for name in chosen])


def rewritten(df: DataFrame, text: str, base: str, seed: Column) -> DataFrame:
    """Replace ``text`` by one in which each span of ``base`` is written in a form of FORMS or left as it is, by hash of its
    place and ``seed``; ``base`` by the spans of these in the new text."""
    whole = F.col(text)

    def form(kind: Column, value: Column, at: Column) -> Column:
        out = value
        for i, k in enumerate(KINDS):
            pick = F.pmod(F.xxhash64(seed, at), F.lit(len(FORMS[k]) + 1))
            for n, steps in enumerate(FORMS[k]):
                changed = value
                for pattern, put in steps:
                    changed = F.regexp_replace(changed, pattern, put)
                out = F.when((kind == i) & (pick == n), changed).otherwise(out)
        return out

    none = F.array().cast("array<struct<start:int,kind:int,end:int>>")

    def step(state: Column, s: Column) -> Column:
        between = F.substring(whole, state["at"] + 1, s["start"] - state["at"])
        value = form(s["kind"], F.substring(whole, s["start"] + 1, s["end"] - s["start"]), s["start"])
        start = state["size"] + F.length(between)
        span = F.struct(start.alias("start"), s["kind"].alias("kind"), (start + F.length(value)).alias("end"))
        fresh = F.struct(s["end"].alias("at"), (start + F.length(value)).alias("size"), F.concat(state["out"], between, value).alias("out"), F.concat(state["spans"], F.array(span)).alias("spans"))
        return F.when(s["start"] >= state["at"], fresh).otherwise(state)

    begin = F.struct(F.lit(0).alias("at"), F.lit(0).alias("size"), F.lit("").alias("out"), none.alias("spans"))
    folded = F.aggregate(base, begin, step)
    df = df.withColumn("_folded", F.when(F.size(base) > 0, folded))
    rest = F.substring(whole, F.col("_folded.at") + 1, F.length(whole))
    return df.withColumns({text: F.when(F.col("_folded").isNotNull(), F.concat("_folded.out", rest)).otherwise(whole), base: F.coalesce("_folded.spans", none)}).drop("_folded")


@dataclass
class Selector:
    """Boosted trees and, by kind, the least probability that selects a candidate; a kind without one adds nothing."""

    trees: list[Tree] = field(default_factory=list)
    thresholds: dict[int, float] = field(default_factory=dict)


def fit_selector(df: DataFrame, *, text: str = "text", doc_id: str = "doc_id") -> Selector:
    """Trees fitted on the candidates of two thirds of all documents, thresholds calibrated on those of the other third, which
    no tree has seen. The labels: in these texts, the checked base spans are first written in forms that the base patterns
    miss; a candidate that such a span covers is right, all others are not. So what is selected is what looks like
    personal data in another form. Nulls in ``doc_id`` and empty tables fit nothing."""
    # texts without any of these characters have no base span and no candidate
    chosen = df.select(F.col(doc_id).alias("_id"), F.col(text).alias("text")).where(F.col("_id").isNotNull() & F.col("text").rlike(r"[0-9@]|at[)\]]"))
    texts = staged(rewritten(base_spans(chosen, "text"), "text", "base", F.col("_id")), "rewritten")
    # explode_outer: from explode, the optimizer would infer a filter that computes all candidates twice
    made = candidates(texts, "text", "base").select("_id", F.explode_outer("found").alias("c")).where(F.col("c").isNotNull()).select("_id", "c.kind_at", "c.label", *[f"c.{f}" for f in FEATURES])
    rows = staged(made.withColumn("held_out", F.pmod(F.xxhash64(F.lit("part"), "_id"), F.lit(3)) == 2).drop("_id"), "candidates")
    trees = boost(rows.where(~F.col("held_out")), FEATURES, "label", ROUNDS)
    if not trees:
        return Selector()
    steps = rows.where("held_out").groupBy("kind_at", F.floor(probability(trees, F.col) * 100).alias("step")).agg(F.sum("label").alias("right"), F.count(F.lit(1)).alias("n")).collect()
    thresholds = {}
    for kind in range(len(KINDS)):
        right = n = 0
        for s in sorted((s for s in steps if s["kind_at"] == kind), key=lambda s: -s["step"]):
            right, n = right + s["right"], n + s["n"]
            if n >= MIN_HELD_OUT and right >= MIN_PRECISION * n and s["step"] >= 50:
                thresholds[kind] = s["step"] / 100
    return Selector(trees, thresholds)


def pii_spans(df: DataFrame, selector: Selector, text: str = "text") -> DataFrame:
    """Add ``base`` and ``spans``, arrays of start, kind (place in KINDS) and end, in code points, end exclusive.

    ``spans`` has all of ``base`` and the candidates that the selector takes, if they overlap neither a base span nor a
    candidate that starts earlier (the longer one on ties). Null and empty texts have none. Other columns stay, whatever
    their names; columns named as the outputs are replaced. Repeated rows each get their spans. No shuffle.
    """
    columns = [c for c in df.columns if c not in ("base", "spans")]
    held = df.select(F.struct(*[df[c] for c in columns]).alias("row"), F.coalesce(df[text], F.lit("")).alias("_text"))
    held = base_spans(held, "_text")
    if not selector.thresholds:
        return held.select("row.*", "base", F.col("base").alias("spans"))
    apart = lambda m, i: ~F.exists("base", lambda b: (b["start"] < m["end"]) & (m["start"] < b["end"]))
    held = candidates(held, "_text", "base", apart, list(selector.thresholds))
    least = F.lit(2.0)
    chosen = lambda c: probability(selector.trees, lambda f: c[f]) >= _threshold(c["kind_at"], selector, least)
    taken = F.when(F.size("found") > 0, F.sort_array(F.transform(F.filter("found", chosen), lambda c: F.struct(c["start"].alias("start"), (-c["end"]).alias("_end"), c["kind_at"].alias("kind"), c["end"].alias("end")))))
    held = held.withColumn("_taken", taken).drop("found")
    none = F.array().cast("array<struct<start:int,kind:int,end:int>>")
    added = F.aggregate(
        "_taken",
        F.struct(F.lit(0).alias("at"), none.alias("out")),
        lambda s, c: F.when(c["start"] >= s["at"], F.struct(c["end"].alias("at"), F.concat(s["out"], F.array(F.struct(c["start"].alias("start"), c["kind"].alias("kind"), c["end"].alias("end")))).alias("out"))).otherwise(s),
        lambda s: s["out"],
    )
    return held.select("row.*", "base", F.sort_array(F.concat("base", F.coalesce(added, none))).alias("spans"))


def _threshold(kind: Column, selector: Selector, other: Column) -> Column:
    out = other
    for k, at in selector.thresholds.items():
        out = F.when(kind == k, at).otherwise(out)
    return out


def redacted(text: Column, spans: str) -> Column:
    """The text with each span replaced by its kind in angle brackets; overlapping spans become one, named by the first."""
    name = lambda kind: F.element_at(F.array(*[F.lit(f"<{k.upper()}>") for k in KINDS]), kind + 1)

    def step(state: Column, s: Column) -> Column:
        between = F.substring(text, state["at"] + 1, s["start"] - state["at"])
        fresh = F.struct(s["end"].alias("at"), F.concat(state["out"], between, name(s["kind"])).alias("out"))
        return F.when(s["start"] >= state["at"], fresh).otherwise(F.struct(F.greatest(state["at"], s["end"]).alias("at"), state["out"].alias("out")))

    folded = F.aggregate(spans, F.struct(F.lit(0).alias("at"), F.lit("").alias("out")), step, lambda s: F.concat(s["out"], F.substring(text, s["at"] + 1, F.length(text))))
    return F.when(F.size(spans) > 0, folded).otherwise(text)


def listed(spans: str) -> Column:
    """kind:start:end, comma-joined."""
    name = lambda kind: F.element_at(F.array(*map(F.lit, KINDS)), kind + 1)
    return F.array_join(F.transform(spans, lambda s: F.concat_ws(":", name(s["kind"]), s["start"].cast("string"), s["end"].cast("string"))), ",")


def op4_pii(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    found = pii_spans(docs, fit_selector(docs))
    count = lambda i: F.size(F.filter("base", lambda b: b["kind"] == i)).cast("long")
    return found.select("doc_id", *[count(i).alias(f"n_{k}") for i, k in enumerate(KINDS)], F.sha2(listed("base"), 256).alias("base_sha256"), listed("spans").alias("spans"))


QUERIES = {"op4_pii": op4_pii}
