"""Secret scans by grammar inference: prefix trees of labelled credentials are merged into probabilistic automata."""

from __future__ import annotations

import math
import re
from collections import Counter, deque
from collections.abc import Iterable
from dataclasses import dataclass, field

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.functions import arrow_udf

from cohortry.llm.common import staged, table

KINDS = ["assign", "access", "hex"]
#: Base patterns; ASCII letters of the key words of an assignment in either case.
ASSIGN = re.compile(r"""(password|passwd|secret|token|api_?key)["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""", re.IGNORECASE | re.ASCII)
ACCESS = re.compile(r"AKIA[A-Z0-9]+")
HEX = re.compile(r"[0-9a-f]{32,}")
#: Every run that may be a credential; all of these are scored. Base spans have as many characters at least.
CANDIDATE = re.compile(r"[A-Za-z0-9+/_=-]{8,}")
KEYWORD = re.compile(r"password|passwd|secret|token|api_?key", re.IGNORECASE | re.ASCII)

#: Labelled credentials of a kind, and as many other candidates, that an automaton is inferred from or calibrated on; by
#: hash, all if there are fewer. Longer ones than FIT_CHARS are scored, but nothing is learned from them.
FIT_STRINGS, FIT_CHARS = 5_000, 512
#: Documents that are searched for them, by hash of their id.
FIT_DOCS = 20_000
#: States merge if their outcomes differ by less than a Hoeffding bound at this confidence.
ALPHA = 0.05
#: At a state of the prefix tree, a character that this share of its strings goes on with has an edge of its own.
LITERAL = 0.5
#: Edges for all other characters: the narrowest of these that has all of them. Any character is in the last.
CLASSES = {
    "digit": frozenset("0123456789"), "hex": frozenset("0123456789abcdef"), "HEX": frozenset("0123456789ABCDEF"), "lower": frozenset("abcdefghijklmnopqrstuvwxyz"), "upper": frozenset("ABCDEFGHIJKLMNOPQRSTUVWXYZ"),
    "lower alnum": frozenset("abcdefghijklmnopqrstuvwxyz0123456789"), "upper alnum": frozenset("ABCDEFGHIJKLMNOPQRSTUVWXYZ0123456789"), "letter": frozenset("abcdefghijklmnopqrstuvwxyzABCDEFGHIJKLMNOPQRSTUVWXYZ"),
    "alnum": frozenset("abcdefghijklmnopqrstuvwxyzABCDEFGHIJKLMNOPQRSTUVWXYZ0123456789"), "any": frozenset(map(chr, range(33, 127))),
}
#: Weight of an outcome that was never seen, spread over all characters.
SMOOTH = 0.5
#: Of the held-out candidates above a kind's threshold, credentials must be this share; without such a threshold, a kind
#: adds nothing. A threshold is at least 0 bits: the format must be likelier than other text.
MIN_PRECISION, MIN_HELD_OUT = 0.98, 20
#: Scored words that a worker remembers; more make it start over.
REMEMBERED = 200_000


class Automaton:
    """A probabilistic automaton from a prefix tree of strings, by merging compatible states in breadth-first order.

    A tree state has an edge for each character that many of its strings go on with and one for the class of all others,
    counts of both and of the strings that end in it. A tree state merges into an accepted state if no frequency of theirs
    differs by more than the Hoeffding bound, recursively along equal edges. Memory: the labelled strings, FIT_STRINGS of
    FIT_CHARS at most, in one process.
    """

    def __init__(self, strings: Iterable[str]):
        self.count: list[int] = []
        self.ends: list[int] = []
        self.next: list[dict[str, int]] = []
        self.seen: list[Counter] = []
        self._tree([s for s in strings])
        self._merge_all()
        self._edges = [sorted((e for e in edges if len(e) > 1), key=lambda e: len(CLASSES[e])) for edges in self.next]

    def _state(self, n: int) -> int:
        self.count.append(n)
        self.ends.append(0)
        self.next.append({})
        self.seen.append(Counter())
        return len(self.count) - 1

    def _tree(self, strings: list[str]) -> None:
        """Breadth first: each state gets the strings that reach it and the place they have reached."""
        todo = deque([(self._state(len(strings)), strings, 0)])
        while todo:
            state, held, at = todo.popleft()
            on = [s for s in held if len(s) > at]
            self.ends[state] = len(held) - len(on)
            if not on:
                continue
            chars = Counter(s[at] for s in on)
            own = {c for c, n in chars.items() if n >= LITERAL * len(on)}
            rest = chars.keys() - own
            name = next((k for k, v in CLASSES.items() if rest <= v), "any") if rest else ""
            parts: dict[str, list[str]] = {}
            for s in on:
                parts.setdefault(s[at] if s[at] in own else name, []).append(s)
            for edge, part in sorted(parts.items()):
                self.seen[state][edge] = len(part)
                child = self.next[state][edge] = self._state(len(part))
                todo.append((child, part, at + 1))

    @staticmethod
    def _differ(x: int, n: int, y: int, m: int) -> bool:
        return n > 0 and m > 0 and abs(x / n - y / m) > math.sqrt(0.5 * math.log(2 / ALPHA)) * (1 / math.sqrt(n) + 1 / math.sqrt(m))

    def _compatible(self, a: int, b: int) -> bool:
        todo, done = [(a, b)], set()
        while todo:
            a, b = todo.pop()
            if (a, b) in done:
                continue
            done.add((a, b))
            if self._differ(self.ends[a], self.count[a], self.ends[b], self.count[b]):
                return False
            for c in self.seen[a].keys() | self.seen[b].keys():
                if self._differ(self.seen[a][c], self.count[a], self.seen[b][c], self.count[b]):
                    return False
                if c in self.next[a] and c in self.next[b]:
                    todo.append((self.next[a][c], self.next[b][c]))
        return True

    def _fold(self, a: int, b: int) -> None:
        """Add the tree below b to the state a."""
        todo = [(a, b)]
        while todo:
            a, b = todo.pop()
            self.count[a] += self.count[b]
            self.ends[a] += self.ends[b]
            for c, n in self.seen[b].items():
                self.seen[a][c] += n
                if c in self.next[a]:
                    todo.append((self.next[a][c], self.next[b][c]))
                else:
                    self.next[a][c] = self.next[b][c]

    def _merge_all(self) -> None:
        accepted, known, fringe = [0], {0}, deque((0, c) for c in sorted(self.next[0]))
        while fringe:
            parent, c = fringe.popleft()
            child = self.next[parent].get(c)
            if child is None or child in known:
                continue
            into = next((a for a in accepted if self._compatible(a, child)), None)
            if into is None:
                accepted.append(child)
                known.add(child)
                fringe += [(child, s) for s in sorted(self.next[child])]
            else:
                self.next[parent][c] = into
                self._fold(into, child)
                fringe += [(into, s) for s in sorted(self.next[into]) if self.next[into][s] not in known]
        self.states = len(accepted)

    def bits(self, s: str) -> float:
        """Log2 likelihood of the characters of s and of its end; an unknown step stays in its state."""
        total, at, wide = 0.0, 0, len(CLASSES["any"])
        for c in s:
            edges, seen = self.next[at], self.seen[at]
            p = SMOOTH / wide + seen.get(c, 0)
            to = edges.get(c)
            for name in self._edges[at]:
                if c in CLASSES[name]:
                    p += seen[name] / len(CLASSES[name])
                    to = edges[name] if to is None else to
            total += math.log2(p / (self.count[at] + 2 * SMOOTH))
            at = at if to is None else to
        return total + math.log2((self.ends[at] + SMOOTH) / (self.count[at] + 2 * SMOOTH))


@dataclass
class Grammar:
    """An automaton for the values of each kind and one for other candidates, and by kind the least log2 odds of the two
    that select a candidate; a kind without one adds nothing."""

    formats: dict[str, Automaton]
    other: Automaton
    thresholds: dict[str, float] = field(default_factory=dict)

    def odds(self, kind: str, s: str) -> float:
        return self.formats[kind].bits(s) - self.other.bits(s)

    def kind_of(self, s: str) -> str | None:
        """The kind whose odds exceed its threshold by most."""
        if not self.thresholds:
            return None
        other = self.other.bits(s)
        over, kind = max((self.formats[k].bits(s) - other - least, k) for k, least in self.thresholds.items())
        return kind if over >= 0 else None


def base_spans(text: str) -> list[tuple[int, int, int]]:
    """(start, place in KINDS, end) of the base spans, in order."""
    found = [(m.start(), 0, m.end()) for m in ASSIGN.finditer(text) if len(m[2]) >= 8] if KEYWORD.search(text) else []
    found += [(m.start(), 1, m.end()) for m in ACCESS.finditer(text) if len(m[0]) >= 16]
    found += [(m.start(), 2, m.end()) for m in HEX.finditer(text)]
    return sorted(found)


def apart(text: str, base: list[tuple[int, int, int]]) -> list[re.Match]:
    """Candidates that touch no base span. Both are in order, so each base span is looked at once or twice."""
    found, at, reach = [], 0, 0
    for m in CANDIDATE.finditer(text):
        while at < len(base) and base[at][0] < m.end():
            reach = max(reach, base[at][2])
            at += 1
        if reach <= m.start():
            found.append(m)
    return found


def _labelled(texts: pa.Array) -> pa.Array:
    """The distinct labelled strings of each text: the values of base spans by kind, and all other candidates."""
    out = []
    for t in texts:
        text = t.as_py()
        base = base_spans(text)
        values = {(KINDS[kind], ASSIGN.match(text[start:end])[2] if kind == 0 else text[start:end]) for start, kind, end in base}
        values |= {("other", m[0]) for m in apart(text, base)}
        out.append([{"kind": k, "value": v} for k, v in sorted(values) if len(v) <= FIT_CHARS])
    return pa.array(out, pa.list_(pa.struct([("kind", pa.string()), ("value", pa.string())])))


def learn_grammar(df: DataFrame, *, text: str = "text", doc_id: str = "doc_id", fit_docs: int = FIT_DOCS, fit_strings: int = FIT_STRINGS) -> Grammar:
    """Automata from the distinct labelled strings of up to ``fit_docs`` documents, up to ``fit_strings`` of each kind; a
    third of the strings, by hash, is held out of the automata and calibrates the thresholds.

    The labels are the base spans; all other candidates count as other text. Null ids are left out; without labelled
    strings the automata are empty and add nothing. The strings that come to the driver are FIT_STRINGS x FIT_CHARS a kind.
    """
    ids = df.where(F.col(doc_id).isNotNull()).select(F.col(doc_id).alias("_id")).distinct().orderBy(F.xxhash64("_id"), "_id").limit(fit_docs)
    chosen = df.select(F.col(doc_id).alias("_id"), F.coalesce(F.col(text), F.lit("")).alias("_t")).join(F.broadcast(ids), "_id")
    strings = staged(chosen.select(F.explode_outer(arrow_udf(_labelled, "array<struct<kind:string,value:string>>")("_t")).alias("s")).where(F.col("s").isNotNull()).select("s.*").distinct(), "strings")
    seen: dict[str, list[str]] = {}
    held: dict[str, list[str]] = {}
    for kind in [*KINDS, "other"]:
        rows = strings.where(F.col("kind") == kind).orderBy(F.xxhash64("value"), "value").limit(fit_strings).collect()
        seen[kind] = [r["value"] for i, r in enumerate(rows) if i % 3 != 2]
        held[kind] = [r["value"] for i, r in enumerate(rows) if i % 3 == 2]
    grammar = Grammar({k: Automaton(seen[k]) for k in KINDS if seen[k]}, Automaton(seen["other"]))
    grammar.thresholds = {k: least for k in grammar.formats if (least := _threshold(grammar, k, held)) is not None}
    return grammar


def _threshold(grammar: Grammar, kind: str, held: dict[str, list[str]]) -> float | None:
    """The least odds, 0 at least, above which held-out strings of the kind are MIN_PRECISION of all held-out ones; halfway
    to the odds that come next."""
    scored = sorted([(grammar.odds(kind, s), 1) for s in held[kind]] + [(grammar.odds(kind, s), 0) for s in held["other"]], reverse=True)
    least, right = None, 0
    for n, (odds, ok) in enumerate(scored, 1):
        right += ok
        if odds < 0:
            break
        if ok and n >= MIN_HELD_OUT and right >= MIN_PRECISION * n:
            least = max(0.0, (odds + scored[n][0]) / 2 if n < len(scored) else odds)
    return least


def scan(text: str, grammar: Grammar, known: dict[str, str | None]) -> tuple[list, list]:
    """Base spans and all spans of a text: the base ones and every candidate apart from them whose format is likely."""
    base = base_spans(text)
    spans = list(base)
    if grammar.thresholds:
        for m in apart(text, base):
            word = m[0]
            if word in known:
                kind = known[word]
            else:
                kind = grammar.kind_of(word)
                if len(word) <= FIT_CHARS:
                    if len(known) >= REMEMBERED:
                        known.clear()
                    known[word] = kind
            if kind is not None:
                spans.append((m.start(), KINDS.index(kind), m.end()))
    return base, sorted(spans)


SPANS = "array<struct<start:int,kind:int,end:int>>"


def secret_spans(df: DataFrame, grammar: Grammar, text: str = "text") -> DataFrame:
    """Add ``base`` and ``spans``, arrays of start, kind (place in KINDS) and end, in code points, end exclusive.

    Null and empty texts have none. Other columns stay, whatever their names; columns named as the outputs are replaced.
    Repeated rows each get their spans; an empty table gives an empty one. No shuffle.
    """

    @arrow_udf(f"struct<base:{SPANS},spans:{SPANS}>")
    def scanned(texts: pa.Array) -> pa.Array:
        item = pa.list_(pa.struct([("start", pa.int32()), ("kind", pa.int32()), ("end", pa.int32())]))
        known: dict[str, str | None] = {}
        both = [scan(t.as_py(), grammar, known) for t in texts]
        columns = [pa.array([[dict(zip(("start", "kind", "end"), s, strict=True)) for s in x[i]] for x in both], item) for i in (0, 1)]
        return pa.StructArray.from_arrays(columns, ["base", "spans"])

    columns = [c for c in df.columns if c not in ("base", "spans")]
    held = df.select(F.struct(*[df[c] for c in columns]).alias("row"), scanned(F.coalesce(df[text], F.lit(""))).alias("scan"))
    return held.select("row.*", "scan.base", "scan.spans")


def listed(spans: str) -> Column:
    name = lambda kind: F.element_at(F.array(*map(F.lit, KINDS)), kind + 1)
    return F.array_join(F.transform(spans, lambda s: F.concat_ws(":", name(s["kind"]), s["start"].cast("string"), s["end"].cast("string"))), ",")


def op5_secret_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    found = secret_spans(docs, learn_grammar(docs))
    count = lambda i: F.size(F.filter("base", lambda b: b["kind"] == i)).cast("long")
    return found.select("doc_id", *[count(i).alias(f"n_{k}") for i, k in enumerate(KINDS)], F.sha2(listed("base"), 256).alias("base_sha256"), listed("spans").alias("spans"))


QUERIES = {"op5_secret_scan": op5_secret_scan}
