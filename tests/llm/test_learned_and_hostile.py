"""What the learned operators add, brute-force versions of their rules, hostile texts, repeated rows and clashing names."""

import hashlib
import math
import random
import re
import time

import public_tokenizers
import pytest
from cohortry.llm import bpe_codec, decontaminate, html_text, language_id, pii, quality_rules, secret_scan, span_dedup, token_counts
from cohortry.llm.boosting import Tree
from cohortry.llm.bpe import TrieCodec, Vocabulary
from pyspark.sql import functions as F

VOCAB = public_tokenizers.path("byte_bpe_50k.json")


def luhn_digits(rng, n=16):
    body = [rng.randrange(1, 10)] + [rng.randrange(10) for _ in range(n - 2)]
    total = sum(d if i % 2 else sum(divmod(2 * d, 10)) for i, d in enumerate(reversed(body)))
    return "".join(map(str, body)) + str(-total % 10)


def private_corpus(n, seed=3):
    rng = random.Random(seed)
    words = lambda: " ".join("word" + "abcdefghij"[rng.randrange(10)] for _ in range(6))
    made = [
        lambda: f"ann.{rng.randrange(100)}@mail{rng.randrange(9)}.example.org",
        lambda: ".".join(str(rng.randrange(1, 255)) for _ in range(4)),
        lambda: luhn_digits(rng),
        lambda: f"+1 ({rng.randrange(200, 999)}) 555-{rng.randrange(1000, 9999)}",
        lambda: str(rng.randrange(10**15, 10**16)),
        lambda: f"{rng.randrange(2000, 2030)}-{rng.randrange(10, 13)}-{rng.randrange(10, 29)}",
        lambda: f"{rng.randrange(10)}.{rng.randrange(100)}",
    ]
    return [(i, f"{words()} {made[i % len(made)]()} {words()}") for i in range(n)]


@pytest.fixture(scope="module")
def selector(spark):
    docs = spark.createDataFrame(private_corpus(1400), "doc_id long, text string").repartition(4)
    return pii.fit_selector(docs)


def added(spark, selector, texts):
    rows = pii.pii_spans(spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string"), selector).collect()
    return {r.doc_id: [(pii.KINDS[s.kind], r.text[s.start : s.end]) for s in r.spans if s not in r.base] for r in rows}


def test_forms_that_the_base_patterns_miss_are_added(spark, selector):
    card = luhn_digits(random.Random(8))
    dots = ".".join(card[i : i + 4] for i in range(0, 16, 4))
    got = added(spark, selector, ["call 1 (603) 555-8791 now", f"paid by {dots} today", "ask bob.7 (at) mail3.example.org please", "from 10[.]20[.]30[.]40 here", "on 2024-10-12 it was 3.14", "number 1234567890123456 is none", "word1 word2"])
    assert {got[0][0][0], got[1][0][0], got[2][0][0], got[3][0][0]} == {"phone", "card", "email", "ip"} and "555-8791" in got[0][0][1] and got[1][0][1] == dots
    assert got[4] == got[5] == got[6] == []


def test_spans_equal_brute_force(spark, selector):
    """Generators, features, trees, thresholds and the choice among overlaps, written in plain Python."""
    texts = [t for _, t in private_corpus(70, 4)] + ["1 (603) 555-8791 190.137.223.20", "a@b.c 603.555.8791 4 4 4 4", "x (at) y.z+1 (843) 555-7672 170.106.47.218", ""]
    rows = pii.pii_spans(spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string"), selector).collect()

    def side(c):
        return 0.0 if c == "" else 1.0 if re.match("[A-Za-z]", c) else 2.0 if re.match("[0-9]", c) else 3.0 if c.isspace() else 4.0

    def features(i, t, a, b):
        v = t[a:b]
        digits = [int(c) for c in re.sub("[^0-9]", "", v)]
        groups = [g for g in re.split("[^0-9]+", v) if g]
        count = lambda p: float(len(re.findall(p, v)))
        luhn = bool(digits) and sum(d if k % 2 == 0 else sum(divmod(2 * d, 10)) for k, d in enumerate(reversed(digits))) % 10 == 0
        octets = all(int(g) <= 255 for g in groups)
        return {
            "kind": float(i), "length": float(len(v)), "digits": count("[0-9]"), "letters": count("[A-Za-z]"), "dots": count("[.]"), "spaces": count(r"\s"), "dashes": count("[-_/]"), "brackets": count(r"[()\[\]]"),
            "others": float(len(re.sub(r"[0-9A-Za-z.\s()/_\[\]@+-]", "", v))), "longest_digits": float(max(map(len, groups), default=0)), "groups": float(len(groups)), "luhn": float(luhn), "octets": float(octets),
            "left": side(t[a - 1 : a] if a else ""), "right": side(t[b : b + 1]),
        }

    def probability(f):
        total = 0.0
        for tree in selector.trees:
            root, low, high = [f[name] > at for name, at in tree.splits]
            total += tree.leaves[(3 if high else 2) if root else (1 if low else 0)]
        return 1 / (1 + math.exp(-total))

    some = 0
    for r in rows:
        t, base = texts[r.doc_id], [tuple(b) for b in r.base]
        found = []
        for _, kind, pattern in pii.GENERATORS:
            i = pii.KINDS.index(kind)
            if i in selector.thresholds and re.search(pii.NEEDS[kind], t):
                for m in re.finditer(pattern.replace(r"(?:\G|", "(?:"), t):
                    a, b = m.span()
                    if not any(s < b and a < e for s, _, e in base) and probability(features(i, t, a, b)) >= selector.thresholds[i]:
                        found.append((a, -b, i))
        end, want = 0, list(base)
        for a, b, i in sorted(found):
            if a >= end:
                end = -b
                want.append((a, i, -b))
                some += 1
        assert [tuple(s) for s in r.spans] == sorted(want)
    assert some


def test_rewritten_spans_hold_the_forms(spark):
    df = pii.base_spans(spark.createDataFrame(private_corpus(300, 5), "doc_id long, text string"), "text")
    rows = pii.rewritten(df, "text", "base", F.col("doc_id")).collect()
    old = {r.doc_id: r for r in df.collect()}
    changed = 0
    for r in rows:
        assert len(r.base) == len(old[r.doc_id].base)
        for s, o in zip(r.base, old[r.doc_id].base, strict=True):
            was, now = old[r.doc_id].text[o.start : o.end], r.text[s.start : s.end]
            assert s.kind == o.kind and r.text[: s.start] == old[r.doc_id].text[: o.start] and r.text[s.end :] == old[r.doc_id].text[o.end :]
            changed += was != now
    assert changed > 50


def test_long_values_take_no_stack(spark, selector):
    long = ["x@a" + ".b" * 200_000, "1" + ".1" * 200_000, "4 " * 200_000, "+" + "1(" * 200_000, "a (at) " * 50_000, "a[dot]" * 50_000, "[.]1" * 100_000, "1[.]" * 100_000, "(" * 100_000 + "1" * 100_000]
    rows = {r.doc_id: r for r in pii.pii_spans(spark.createDataFrame(list(enumerate(long)), "doc_id long, text string"), selector).collect()}
    assert [tuple(s) for s in rows[0].base] == [(0, 0, len(long[0]))] and len(rows) == len(long)


def credentials(n):
    key = lambda i: hashlib.sha1(str(i).encode()).hexdigest()
    upper = lambda i: "".join("ABCDEFGHIJKLMNOPQRSTUVWXYZ234567"[int(c, 16) + 16 * (k % 2)] for k, c in enumerate(key(i)[:16]))
    texts = []
    for i in range(n):
        texts += [f"words password={key(i)[:18]} and more", f"then AKIA{upper(i)} elsewhere", f"value {key(i + n)} stands here, number {4 * 10**15 + i * 7919}", "plain extraordinarily lengthy sentences containing considerable vocabulary"]
    return texts


def test_automata_have_states_and_add_what_fits(spark):
    docs = spark.createDataFrame(list(enumerate(credentials(150))), "doc_id long, text string")
    grammar = secret_scan.learn_grammar(docs)
    assert set(grammar.formats) == set(secret_scan.KINDS) and all(a.states > 5 for a in grammar.formats.values()) and set(grammar.thresholds) == set(secret_scan.KINDS)
    bare = hashlib.sha1(b"another").hexdigest()[:18]
    texts = [f"a bare {bare} without its key word", "number 4000000000123456 of an order", "extraordinarily considerable", f"xpassword={bare} {bare}", "AKIAABCDEFGH", None, ""]
    rows = {r.doc_id: r for r in secret_scan.secret_spans(spark.createDataFrame([(i, t) for i, t in enumerate(texts)] * 2, "doc_id long, text string"), grammar).collect()}
    assert [tuple(s) for s in rows[0].spans] == [(7, 0, 25)] and not rows[0].base
    assert [tuple(s) for s in rows[3].base] == [(1, 0, 28)] and [tuple(s) for s in rows[3].spans] == [(1, 0, 28), (29, 0, 47)]
    assert not any(rows[i].spans for i in (1, 2, 5, 6))


def test_secret_spans_equal_brute_force(spark):
    texts = credentials(120)
    docs = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    grammar = secret_scan.learn_grammar(docs)

    def bits(a, s):
        total, at = 0.0, 0
        for c in s:
            names = [e for e in a.next[at] if len(e) > 1 and c in secret_scan.CLASSES[e]]
            p = secret_scan.SMOOTH / 94 + a.seen[at].get(c, 0) + sum(a.seen[at][e] / len(secret_scan.CLASSES[e]) for e in names)
            total += math.log2(p / (a.count[at] + 2 * secret_scan.SMOOTH))
            at = a.next[at].get(c, a.next[at][min(names, key=lambda e: len(secret_scan.CLASSES[e]))] if names else at)
        return total + math.log2((a.ends[at] + secret_scan.SMOOTH) / (a.count[at] + 2 * secret_scan.SMOOTH))

    odd = ["key " + "ab12" * 5, "e1c093f22d3955eaac e1c093f22d3955eaacf", "ZZZZ" * 6, "a=b=c=d=e=f", "token:" + "x" * 600]
    rows = secret_scan.secret_spans(spark.createDataFrame(list(enumerate(texts + odd)), "doc_id long, text string"), grammar).collect()
    for r in rows:
        base = [tuple(b) for b in r.base]
        want = list(base)
        for m in re.finditer(r"[A-Za-z0-9+/_=-]{8,}", r.text):
            if not any(s < m.end() and m.start() < e for s, _, e in base):
                over = [(bits(grammar.formats[k], m[0]) - bits(grammar.other, m[0]) - least, k) for k, least in grammar.thresholds.items()]
                if over and max(over)[0] >= 0:
                    want.append((m.start(), secret_scan.KINDS.index(max(over)[1]), m.end()))
        assert [tuple(s) for s in r.spans] == sorted(want)


PROSE = "the house of the river was not in the valley and it is the one that they have seen from the road with all of it"


def test_both_passes_decide_without_an_article(monkeypatch):
    stops = frozenset("the of was not in and it is that they have from with all".split())
    page = f"""<div class=x><h2>A title</h2><p>{PROSE}</p><p>Short one.</p><p>the words of a line are not so few in it</p></div>
    <div><p><a href=1>Read this other long page about many more things today and then one after it that has still more of the same kind for you to see here</a></p><p>Buy now</p><p>Order Key Lamp Desk Chair Table Door Bell Wall Floor Roof Pipe</p></div>"""
    text = html_text.main_text(page, stops)
    assert text.split("\n\n") == ["A title", PROSE, "Short one.", "the words of a line are not so few in it"]
    assert html_text.main_text(page) != text  # without stop words
    monkeypatch.setattr(html_text, "MAX_LINKS", 2.0)
    assert html_text.main_text(page, stops) != text  # without link density
    monkeypatch.undo()
    monkeypatch.setattr(html_text, "first_pass", lambda *a: None)
    assert html_text.main_text(page, stops) == ""
    monkeypatch.undo()
    first = [html_text.first_pass(b, 0, stops) for b in html_text.blocks_of(page)[0]]
    assert None in first and True in first and False in first  # without the second pass, open blocks were lost


def test_second_pass_equals_brute_force():
    stops = frozenset(PROSE.split())
    rng = random.Random(2)
    for _ in range(200):
        parts = [rng.choice([PROSE, "Short", "Two words", "<a href=x>linked text of some length here</a>", "Order Key Lamp Desk Chair Table Door Bell Wall Floor Roof"]) for _ in range(rng.randrange(1, 9))]
        page = "".join(f"<p>{p}</p>" for p in parts)
        page = f"<article>{page}</article>" if rng.random() < 0.5 else page
        blocks, words = html_text.blocks_of(page)
        region = max(words, key=lambda r: (words[r], -r), default=0)
        labels = [html_text.first_pass(b, region, stops) for b in blocks]
        decided = [i for i, x in enumerate(labels) if x is not None]
        want = []
        for i, b in enumerate(blocks):
            label = labels[i]
            if label is None:
                nearest = min(decided, key=lambda j: (abs(j - i), -j), default=None)
                label = labels[nearest] if nearest is not None else bool(region)
            if label:
                want.append(b.text)
        assert html_text.main_text(page, stops) == "\n\n".join(want)


@pytest.mark.parametrize("piece", ["<a ", '<a b="', "<!", "<!--", "<a \"<b '", "<script ", "<script>", "</script ", "<div>", "</p></section>", "&", '"', "<a href='x' ", "<p", "]]>", "<style></style "])
def test_unclosed_markup_takes_linear_time(piece):
    began = time.perf_counter()
    html_text.main_text(piece * 60_000)
    assert time.perf_counter() - began < 5


def test_pages_in_any_language_and_odd_markup(spark):
    other = " ".join(f"szó{i}" for i in range(30))
    assert html_text.main_text(f"<div><p>{other}</p></div>") == other
    assert html_text.main_text("<article><p>a &am<b>p;</b> b &lt;p&gt;</p></article>") == "a &amp; b <p>".replace("&amp;", "&amp;") and html_text.main_text("<article>x &amp; y") == "x & y"
    pages = spark.createDataFrame([(1, None, "u"), (2, "", "u"), (3, f"<article><p>{PROSE}", "u"), (3, f"<article><p>{PROSE}", "u")], "page_id long, html string, n_chars string")
    rows = html_text.extract_text(pages).collect()
    assert sorted((r.page_id, r.text, r.n_chars) for r in rows) == [(1, "", "u"), (2, "", "u"), (3, PROSE, "u"), (3, PROSE, "u")]
    assert html_text.extract_text(pages.where("page_id < 0")).count() == 0


def test_stop_words_are_the_frequent_ones_of_the_pages(spark):
    pages = spark.createDataFrame([(i, f"<p>common words {i}{'x' * i} rare{'abc'[i % 3] * i}</p>") for i in range(12)], "page_id long, html string")
    assert {"common", "words"} >= html_text.learned_stops(pages) > set()


def brute_spans(rows):
    """Runs of two sentences and 20 words at least, the fewest from each sentence on and up to each."""
    seen, out = {}, {}
    for key, text in sorted({(k, t) for k, t in rows if t}, key=lambda r: (r[0] is not None, r[0] or 0)):
        places = span_dedup.sentences(text)
        words = [text[a:b].split() for a, b in places]
        runs = set()
        for i in range(len(places)):
            for j in range(i + 2, len(places) + 1):
                if sum(map(len, words[i:j])) >= 20:
                    runs.add((i, j))
                    break
        for j in range(len(places), 0, -1):
            for i in range(j - 2, -1, -1):
                if sum(map(len, words[i:j])) >= 20:
                    runs.add((i, j))
                    break
        gone = set()
        for i, j in sorted(runs, key=lambda r: (places[r[0]][0], places[r[1] - 1][1])):
            if seen.setdefault(tuple(w for s in words[i:j] for w in s), (key, i, j)) != (key, i, j):
                gone |= {p for a, b in places[i:j] for p in range(a, b)}
        out[key, text] = "".join(c for p, c in enumerate(text) if p not in gone)
    return out


def test_span_dedup_equals_brute_force(spark):
    rng = random.Random(11)
    pool = [" ".join(f"w{rng.randrange(40)}" for _ in range(rng.choice([1, 3, 9, 14, 25]))).capitalize() + rng.choice([".", "!", '."', "?"]) for _ in range(25)]
    rows = []
    for i in range(60):
        at = rng.randrange(len(pool) - 6)
        parts = [" ".join(f"own{rng.randrange(10**6)}" for _ in range(8)) + "."] + pool[at : at + rng.randrange(1, 6)] + ["End of it."]
        rows.append((i, rng.choice([" ", "\n", "  "]).join(parts)))
    rows += [(60, rows[0][1]), (None, rows[3][1]), (61, None), (62, "")]
    df = spark.createDataFrame([(k, t, 1, 2, 3) for k, t in rows], "doc_id long, text string, _id int, _digest int, row int")
    got = span_dedup.span_dedup(df)
    assert got.columns == ["doc_id", "text", "_id", "_digest", "row", "removed"]
    want = brute_spans(rows)
    for r, t in ((r, dict(rows)[r.doc_id]) for r in got.collect()):
        assert r.text == (want[r.doc_id, t] if t else t)
    assert any(want[k] != k[1] for k in want)


def test_german_nouns_do_not_end_sentences():
    assert len(span_dedup.sentences("Der Hund und die Katze im Haus von Herrn Meier. Der Baum!")) == 2


def test_long_words_are_not_remembered():
    codec = TrieCodec(Vocabulary(open(VOCAB, encoding="utf-8").read()))
    long = "字" * 5_000
    ids = codec.encode([long, "two words", long])
    assert codec.decode(b"".join(ids[0])) == long and not any(len(w) > 256 for w in codec.words)


def test_columns_of_any_name_stay(spark):
    names = ["doc_id", "text", "_text", "_scan", "_words", "_id", "_digest", "row", "scan", "found", "_codec", "words"]
    df = spark.createDataFrame([(i, "one two three four five six seven eight nine ten", *["kept"] * 10) for i in (1, 1, 2)], names)
    made = {
        "pii": pii.pii_spans(df, pii.Selector([Tree([("kind", 0.0)] * 3, [0.0] * 4)], {0: 0.9})), "secrets": secret_scan.secret_spans(df, secret_scan.Grammar({}, secret_scan.Automaton([]))),
        "rules": quality_rules.quality_rules(df, []), "dedup": span_dedup.span_dedup(df), "bpe": bpe_codec.encode(df, VOCAB), "count": token_counts.token_counts(df, VOCAB),
    }
    for what, got in made.items():
        rows = got.collect()
        assert len(rows) == 3 and all(r[n] == "kept" for r in rows for n in names[2:] if n in got.columns), what
        assert {n for n in names if n not in got.columns} == set(), what
    model = language_id.fit(df.withColumn("lang", F.lit("en")))
    assert language_id.identify(df, model).count() == 3
    assert decontaminate.decontaminate(df, df.withColumnRenamed("doc_id", "item_id")).where("n_hit = 10").count() == 3
