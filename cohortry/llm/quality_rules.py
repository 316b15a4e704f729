"""Quality rules: base counts of a text, and a decision list learned from labels by sequential covering."""

from __future__ import annotations

import math
from dataclasses import dataclass, field

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from cohortry.llm.binning import binned, quantile_edges, sums_by_bin
from cohortry.llm.common import settled, staged, table, words_of

GAP = r"[\x20\x09-\x0D]"
#: Labelled documents that the rules are learned from, by hash of their id; all if there are fewer.
FIT_ROWS = 20_000
BINS = 32
MAX_RULES, MAX_CONDITIONS = 8, 3
#: On rows that it was not grown on, a rule must be right this often, and surely right (``surely``) this often.
MIN_PRECISION, MIN_SURE = 0.9, 0.7
FEATURES = ["symbol_share", "upper_share", "digit_share", "repeat_share", "stutter_share", "dup_line_share", "word_length", "n_words"]


def measured(df: DataFrame, text: str = "text") -> DataFrame:
    """Add n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words, base_failed and the shares in FEATURES.

    Null counts as the empty text: all counts are 0 and base_failed is true. Columns of these names are replaced.
    """
    made = ["n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed", *FEATURES[:-1]]
    held = df.select(F.struct(*[df[c] for c in df.columns if c not in made]).alias("row"), F.coalesce(df[text], F.lit("")).alias("_text"))
    t = F.col("_text")
    no_space = F.translate(t, " \t\n\x0b\f\r", "")
    count = lambda chars: F.length(t) - F.length(F.translate(t, chars, ""))
    lines = F.filter(F.split(t, "\n"), lambda line: line.rlike(r"[^\x20\x09-\x0D]"))
    out = held.withColumns({
        "_words": words_of(t, GAP), "_lines": lines, "word_chars": F.length(no_space).cast("long"), "n_symbols": count("#*$%&|<>").cast("long"),
        "_upper": count("ABCDEFGHIJKLMNOPQRSTUVWXYZ"), "_digits": count("0123456789"),
    })
    n = F.size("_words")
    runs = F.transform(F.sequence(F.lit(1), n - 4), lambda i: F.xxhash64(F.slice("_words", i, 5)))
    out = out.withColumns({"n_words": n.cast("long"), "n_dup_lines": (F.size("_lines") - F.size(F.array_distinct("_lines"))).cast("long"), "_runs": F.when(n >= 5, runs), "_stutter": F.size(F.filter("_words", lambda w, i: w == F.get("_words", i + 1))), "_n_lines": F.size("_lines")})
    # only texts that repeat a run sort their runs, to find the places
    repeats = F.size(F.array_distinct("_runs")) < F.size("_runs")
    out = out.withColumn("_sorted", F.when(repeats, F.sort_array(F.transform("_runs", lambda h, i: F.struct(h.alias("h"), i.alias("i"))))))
    twice = F.filter("_sorted", lambda x, i: (x["h"] == F.get("_sorted", i - 1)["h"]) | (x["h"] == F.get("_sorted", i + 1)["h"]))
    places = F.sort_array(F.transform(twice, lambda x: x["i"]))
    covered = F.aggregate(
        places,
        F.struct(F.lit(0).cast("long").alias("total"), F.lit(0).alias("end")),
        lambda s, i: F.struct((s["total"] + F.lit(5) - F.greatest(s["end"] - i, F.lit(0))).alias("total"), (i + 5).alias("end")),
        lambda s: s["total"],
    )
    out = out.withColumn("n_repeat_words", F.coalesce(covered, F.lit(0).cast("long")))
    share = lambda a, b: F.coalesce(F.try_divide(F.col(a).cast("double"), F.col(b).cast("double")), F.lit(0.0))
    out = out.withColumns({
        "base_failed": (F.col("n_words") < 10) | (100 * F.col("n_repeat_words") > 20 * F.col("n_words")),
        "symbol_share": share("n_symbols", "word_chars"), "upper_share": share("_upper", "word_chars"), "digit_share": share("_digits", "word_chars"),
        "repeat_share": share("n_repeat_words", "n_words"), "stutter_share": share("_stutter", "n_words"), "dup_line_share": share("n_dup_lines", "_n_lines"),
        "word_length": share("word_chars", "n_words"),
    })
    return out.select("row.*", *made)


@dataclass
class Rule:
    """A conjunction of (feature, above, threshold); ``above`` tells whether the value must exceed the threshold."""

    conditions: list[tuple[str, bool, float]] = field(default_factory=list)
    precision: float = 0.0
    covered: int = 0

    def column(self) -> Column:
        held = F.lit(True)
        for name, above, at in self.conditions:
            held = held & ((F.col(name) > at) if above else (F.col(name) <= at))
        return held

    def __str__(self) -> str:
        return " and ".join(f"{n} {'>' if a else '<='} {t:.4g}" for n, a, t in self.conditions) + f" (precision {self.precision:.3f}, covers {self.covered})"


def surely(right: int, covered: int, z: float = 1.645) -> float:
    """The lower end of the one-sided 95 % Wilson interval of a share: what few rows can show, and many show better."""
    if not covered:
        return 0.0
    p, w = right / covered, z * z / covered
    return (p + w / 2 - z * math.sqrt(p * (1 - p) / covered + w / covered / 4)) / (1 + w)


def _condition(edges: dict, name: str, above: bool, cut: int) -> Column:
    return F.col(name) > cut if above else F.col(name) <= cut


def _grow(rows: DataFrame, edges: dict) -> list[tuple[str, bool, int]]:
    """Add the condition with the most information gain until no bad row is left or nothing is gained."""
    rule: list[tuple[str, bool, int]] = []
    bad = (F.col("label") == 0).cast("long")
    while len(rule) < MAX_CONDITIONS:
        covered = rows
        for c in rule:
            covered = covered.where(_condition(edges, *c))
        sums = sums_by_bin(covered, list(edges), {"p": bad, "n": 1 - bad})
        if not sums:
            break
        one = [s for s in sums if s["feature"] == sums[0]["feature"]]
        all_p, all_n = sum(s["p"] for s in one), sum(s["n"] for s in one)
        if not all_p or not all_n:
            break
        before, best = math.log2(all_p / (all_p + all_n)), (0.0, None)
        for name in edges:
            own = {s["bin"]: (s["p"], s["n"]) for s in sums if s["feature"] == name}
            low_p = low_n = 0
            for cut in range(len(edges[name])):
                p, n = own.get(cut, (0, 0))
                low_p, low_n = low_p + p, low_n + n
                for above, x, y in ((False, low_p, low_n), (True, all_p - low_p, all_n - low_n)):
                    gain = x * (math.log2(x / (x + y)) - before) if x else 0.0
                    if gain > best[0] * (1 + 1e-9) and (x, y) != (all_p, all_n):
                        best = (gain, (name, above, cut))
        if best[1] is None:
            break
        rule.append(best[1])
    return rule


def _prune(rows: DataFrame, edges: dict, rule: list) -> tuple[list, float, int]:
    """The shortest beginning of a rule that is as good as any on held-back rows, by (p - n) / (p + n)."""
    bad = (F.col("label") == 0).cast("long")
    sums = []
    for k in range(1, len(rule) + 1):
        held = F.lit(True)
        for c in rule[:k]:
            held = held & _condition(edges, *c)
        sums += [F.sum(F.when(held, bad)).alias(f"p{k}"), F.sum(F.when(held, 1 - bad)).alias(f"n{k}")]
    row = rows.agg(*sums).first()
    scored = [(k, row[f"p{k}"] or 0, row[f"n{k}"] or 0) for k in range(1, len(rule) + 1)]
    k, p, n = max(scored, key=lambda x: ((x[1] - x[2]) / (x[1] + x[2]) if x[1] + x[2] else -1, -x[0]))
    return rule[:k], p / (p + n) if p + n else 0.0, p + n


def learn_rules(labelled: DataFrame) -> list[Rule]:
    """An ordered list of rules for label 0 over FEATURES, learned from rows of FEATURES, ``label`` and ``part``.

    A rule that held-back rows do not bear out is tried again without the feature that it began with, until no feature is left.
    ``part`` 0 and 1 grow rules, 2 prunes and accepts them. Each rule sees what the ones before left. Every step gets its
    statistics, sums by feature and bin, from Spark; only those come to the driver. No rows or one label give no rules.
    """
    edges = {f: e for f, e in quantile_edges(labelled, FEATURES, BINS).items() if e}
    if not edges:
        return []
    left = staged(binned(labelled, edges, ["label", "part"]), "labelled")
    rules: list[Rule] = []
    starts = dict(edges)
    while len(rules) < MAX_RULES:
        grown = _grow(left.where("part < 2"), starts)
        if not grown:
            break
        kept, precision, covered = _prune(left.where("part = 2"), edges, grown)
        if precision < MIN_PRECISION or surely(round(precision * covered), covered) < MIN_SURE:
            del starts[grown[0][0]]  # the next best start, without the feature that this one began with
            continue
        starts = dict(edges)
        rules.append(Rule([(name, above, edges[name][cut]) for name, above, cut in kept], precision, covered))
        held = F.lit(True)
        for c in kept:
            held = held & _condition(edges, *c)
        left = left.where(~held)
    return _centred(labelled, rules)


def _centred(labelled: DataFrame, rules: list[Rule]) -> list[Rule]:
    """Thresholds moved half way to the next value seen; every labelled row stays on its side."""
    flat = [c for r in rules for c in r.conditions]
    if not flat:
        return rules
    above = labelled.agg(*[F.min(F.when(F.col(n) > t, F.col(n).cast("double"))).alias(f"c{i}") for i, (n, _, t) in enumerate(flat)]).first()
    moved = iter([(n, a, (t + above[i]) / 2 if above[i] is not None else t) for i, (n, a, t) in enumerate(flat)])
    return [Rule([next(moved) for _ in r.conditions], r.precision, r.covered) for r in rules]


def fitted_rules(documents: DataFrame, labels: DataFrame, *, text: str = "text", doc_id: str = "doc_id", label: str = "quality", fit_rows: int = FIT_ROWS) -> list[Rule]:
    """Rules from up to ``fit_rows`` labelled documents: those whose ids have the least hashes. Null labels and ids are left out."""
    chosen = labels.where(F.col(label).isNotNull() & F.col(doc_id).isNotNull()).select(F.col(doc_id).alias("_id"), F.col(label).alias("label"))
    chosen = chosen.groupBy("_id").agg(F.min("label").alias("label")).orderBy(F.xxhash64("_id"), "_id").limit(fit_rows)
    met = documents.select(F.col(doc_id).alias("_id"), F.col(text).alias("text")).join(F.broadcast(chosen), "_id")
    rows = measured(met).select(*FEATURES, "label", F.pmod(F.xxhash64(F.lit("part"), "_id"), F.lit(3)).alias("part"))
    return learn_rules(staged(rows, "features"))


def quality_rules(df: DataFrame, rules: list[Rule], text: str = "text") -> DataFrame:
    """``measured`` with ``rule`` (the place of the first rule that holds, from 1; null if none) and ``kept``.

    A document is kept if it did not fail the base rules and no rule holds. All input columns stay; those named as
    outputs are replaced; repeated rows each get their result; an empty table gives an empty one. No shuffle.
    """
    first = F.lit(None).cast("int")
    for k in range(len(rules), 0, -1):
        first = F.when(rules[k - 1].column(), k).otherwise(first)
    return measured(df, text).withColumn("rule", first).withColumn("kept", settled(~F.col("base_failed") & F.col("rule").isNull()))


def op3_quality_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    rules = fitted_rules(docs, table(spark, sf_dir, "labels"))
    made = quality_rules(docs, rules).select("doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed", "kept", "rule")
    return made.withColumn("n_rules", F.lit(len(rules)).cast("long"))  # 0: nothing could be learned from the labels, and the base rules decide


QUERIES = {"op3_quality_rules": op3_quality_rules}
