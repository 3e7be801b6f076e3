"""Operators 1, 2, 3, 4 and 9: mixing, quality, language and URL rules."""

import random
import unicodedata
from collections import Counter

import duckdb
import numpy as np
import pyarrow as pa
import pytest
import regex

from docweave.llm import common, language, linelabel, mixing, quality, queries, urls, words

from . import brute
from .fixtures import DATA, frame, rows


@pytest.fixture(autouse=True)
def shipped(spark):
    common.ship(spark)


def plain_targets(sizes):
    """{source: target}: weights 1, 2, 3 by code point with null last; stopped sources' excess is shared anew until none is over."""
    order = sorted(sizes, key=lambda s: (s is None, s or ""))
    weight = {s: i % 3 + 1 for i, s in enumerate(order)}
    rest, left, out = set(order), float(sum(sizes.values())), {}
    while rest:
        total = sum(weight[s] for s in rest)
        over = [s for s in rest if left * weight[s] / total > 3 * sizes[s]]
        if not over:
            return out | {s: left * weight[s] / total for s in rest}
        for s in over:
            out[s] = 3.0 * sizes[s]
        left -= sum(out[s] for s in over)
        rest -= set(over)
    return out


def mixed_rows():
    rng = random.Random(1)
    out = []
    for i in range(3000):
        source = rng.choices(["a", "b", "B", "é", "", None, "tiny"], [30, 5, 3, 10, 2, 1, 0.3])[0]
        out.append((i, " ".join(["w"] * int(rng.lognormvariate(3, 1.2))), "en", source, None, 7, "c", "t"))
    return out + [out[9], out[9], (None, "a b", None, "a", None, None, None, None), (5000, None, None, "void", None, None, None, None), (5001, " ", None, "void", None, None, None, None)]


def test_mixing_meets_targets(spark):
    table = mixed_rows()
    got = mixing.copies(frame(spark, table)).collect()
    assert Counter((r.doc_id, r.size) for r in got) == Counter((t[0], len(brute.words(t[1]))) for t in table)
    sizes = Counter()
    for t in table:
        sizes[t[3]] += len(brute.words(t[1]))
    want = plain_targets(sizes)
    taken, most = Counter(), Counter()
    for r in got:
        assert r.source_size == sizes[r.source]
        assert r.target == pytest.approx(want[r.source])
        assert 0 <= r.copies <= 3
        taken[r.source] += r.copies * r.size
        most[r.source] = max(most[r.source], r.size)
    for s in sizes:
        assert abs(taken[s] - want[s]) <= max(0.05 * want[s], 3 * most[s])
    again = mixing.copies(frame(spark, table, 5)).collect()
    assert Counter(again) == Counter(got)


def test_mix_repeats_rows_as_often_as_it_takes_them(spark):
    table = mixed_rows()
    wanted = Counter()
    for r in mixing.copies(frame(spark, table)).collect():
        wanted[r.doc_id, r.source, r.size] += r.copies
    out = mixing.mix(frame(spark, table))
    assert out.columns == frame(spark, table).columns
    got = Counter((r.doc_id, r.source, len(brute.words(r.text))) for r in out.collect())
    assert got == Counter({k: n for k, n in wanted.items() if n})


def test_mix_keeps_columns_of_any_name(spark):
    table = [(i, f"w{i} " * (i % 7 + 1), "ab"[i % 2], i, "s", "r", 5) for i in range(60)] + [(None, f"n{i}", "a", 99, "s", "r", 5) for i in range(9)]
    df = spark.createDataFrame(table, "doc_id long, text string, source string, _size int, _copies string, row string, copies int")
    out = mixing.mix(df)
    assert out.columns == df.columns
    assert {tuple(r) for r in out.collect()} <= {tuple(r) for r in df.collect()}
    assert any(r.doc_id is None for r in out.collect())


def test_mixing_plans_are_cut_at_each_step(spark):
    docs = frame(spark, [(i, "a b c", None, "xy"[i % 2], None, None, None, None) for i in range(20)])
    for out in (mixing.mix(docs), mixing.copies(docs)):  # the driver holds, plans anew and reports each stage of a plan
        assert out._jdf.queryExecution().executedPlan().toString().count("Exchange") <= 8


def test_mixing_of_nothing(spark):
    empty = frame(spark, []).where("false")
    assert mixing.copies(empty).collect() == [] == mixing.mix(empty).collect()
    void = mixing.copies(frame(spark, [(1, None, None, "s", None, None, None, None)])).collect()
    assert [(r.size, r.target, r.copies) for r in void] == [(0, 0.0, 0)]


def test_base_measures(spark):
    def plain(text):
        text = text or ""
        w = brute.words(text)
        lines = [x for x in text.split("\n") if brute.words(x)]
        seen, again = set(), 0
        for x in lines:
            again += x in seen
            seen.add(x)
        at = Counter(tuple(w[i : i + 3]) for i in range(len(w) - 2))
        hit = {i + k for i in range(len(w) - 2) if at[tuple(w[i : i + 3])] > 1 for k in range(3)}
        return len(w), sum(map(len, w)), sum(c in "#*$%&|<>" for c in text), again, len(hit)

    table = rows()
    text_of = {r[0]: r[1] for r in table}
    got = linelabel.judge(frame(spark, table), linelabel.Field()).collect()
    assert len(got) == len(table)
    for r in got:
        if r.doc_id is not None:
            want = plain(text_of[r.doc_id])
            assert tuple(r)[1:6] == want
            assert r.base_failed == (want[0] < 50 or 100 * want[4] > 50 * want[0])
            assert not (r.base_failed and r.kept)


def test_viterbi_finds_the_best_path_and_the_gradient_is_right():
    rng = np.random.default_rng(0)
    k = len(linelabel.FEATURES)
    for n in (1, 2, 5):
        field = linelabel.Field(rng.standard_normal(k), rng.standard_normal((2, 2)))
        x = (rng.random((n, k)) < 0.5).astype(float)
        paths = [[i >> j & 1 for j in range(n)] for i in range(1 << n)]

        def value(y, f=field, x=x):
            return sum((x[i] @ f.weights) * y[i] for i in range(len(y))) + sum(f.steps[a, b] for a, b in zip(y, y[1:], strict=False))

        assert value(field.viterbi(x)) == pytest.approx(max(map(value, paths)))
        y = paths[-2]
        weights, _ = field.gradient(x[None], np.array([y]))
        likely = lambda f: value(y, f) - np.logaddexp.reduce([value(p, f) for p in paths])
        bump = np.eye(k)[0] * 1e-5
        slope = (likely(linelabel.Field(field.weights + bump, field.steps)) - likely(linelabel.Field(field.weights - bump, field.steps))) / 2e-5
        assert weights[0] == pytest.approx(slope, abs=1e-4)


def plain_features_of_lines(lines):
    """The line features by plain words and counts, in the order of linelabel.FEATURES."""
    out = []
    for k, line in enumerate(lines):
        w = line.split()
        symbols, bars, shouts = sum(c in "#*$%&|<>" for c in line), sum(c == "|" for c in line), sum(c == "!" for c in line)
        shouted, ends = [x for x in w if x.isupper() and len(x) > 1], [x for x in w if x[-1] in "#*$%&|<>"]
        out.append([
            True, symbols > len(line) / 50, symbols > len(line) / 12, bars > len(w) / 4, len(shouted) > len(w) / 2, shouts > len(w) / 3, len(ends) > len(w) / 3,
            len(w) >= 8 and len(set(w)) < len(w) / 2, line in lines[:k], len(w) < 4, line.rstrip().endswith((".", "?", "\u2026")), len(w) >= 20,
        ])
    return out


def plain_labels(field, features):
    """The labels of the best path by a table of all steps; at a tie content, as late a step to boilerplate as can be."""
    if not features:
        return []
    score = [sum(w for w, on in zip(field.weights.tolist(), f, strict=True) if on) for f in features]
    best = [{0: (0.0, [0]), 1: (score[0], [1])}]
    for s in score[1:]:
        row = {}
        for to in (0, 1):
            ways = [(best[-1][was][0] + float(field.steps[was, to]) + (s if to else 0.0), best[-1][was][1]) for was in (0, 1)]
            pick = ways[1] if (ways[1][0] > ways[0][0] or (to == 1 and ways[1][0] == ways[0][0])) else ways[0]
            row[to] = pick[0], [*pick[1], to]
        best.append(row)
    return best[-1][1][1] if best[-1][1][0] > best[-1][0][0] else best[-1][0][1]


def test_kept_matches_a_plain_version(spark):
    d = DATA.replace("0.001", "0.01")
    docs, labels = spark.read.parquet(f"{d}/documents.parquet"), spark.read.parquet(f"{d}/labels.parquet")
    field = linelabel.fit(docs, labels)
    assert field.weights.any()
    sloped = linelabel.Field(field.weights, np.array([[0.0, -0.7], [0.4, 0.9]]))
    texts = {r.doc_id: r.text for r in docs.collect()} | {10_000 + k: r[1] for k, r in enumerate(rows())}
    table = spark.createDataFrame(list(texts.items()), "doc_id long, text string").repartition(4)
    for model in (field, sloped):
        turned = 0
        for r in linelabel.judge(table, model).collect():
            lines = [x for x in (texts[r.doc_id] or "").split("\n") if brute.words(x)]
            junk = plain_labels(model, plain_features_of_lines(lines))
            content = sum(len(brute.words(x)) for x, j in zip(lines, junk, strict=True) if not j)
            assert (r.content_words, r.kept) == (content, not r.base_failed and content >= 0.5 * r.n_words), r.doc_id
            turned += not r.base_failed and not r.kept
        assert turned > 10


def test_quality_rules_agree_with_the_labels(spark):
    d = DATA.replace("0.001", "0.01")
    docs, labels = spark.read.parquet(f"{d}/documents.parquet"), spark.read.parquet(f"{d}/labels.parquet")
    got = linelabel.judge(docs, linelabel.fit(docs, labels)).join(labels, "doc_id").where("not base_failed").collect()
    good = [r for r in got if r.quality == 1]
    assert np.mean([r.kept for r in good]) > 0.97
    assert docs.count() == linelabel.keep_good(docs, linelabel.Field()).count() + linelabel.judge(docs, linelabel.Field()).where("not kept").count()
    nothing = linelabel.fit(docs, labels.where("false"))
    assert not nothing.weights.any()


def test_em_recovers_accuracies():
    rng = np.random.default_rng(4)
    truth = rng.random(20_000) < 0.7
    right = np.array([0.9, 0.8, 0.75, 0.85])
    says = np.where(rng.random((20_000, 4)) < right, truth[:, None], ~truth[:, None]).astype(int)
    says[rng.random((20_000, 4)) < 0.2] = -1
    patterns, n = np.unique(says, axis=0, return_counts=True)
    weak = quality.estimate(patterns, n.astype(float))
    assert np.allclose(weak.accuracy(), right, atol=0.03)
    assert weak.prior == pytest.approx(0.7, abs=0.03)


def plain_votes(text):
    """The labellers' votes by regular expressions."""
    text = text or ""
    w, lines = brute.words(text), [x for x in text.split("\n") if brute.words(x)]
    n, size, kinds, varied = max(1, len(w)), max(1, len(text)), len(set(w)), len(set(w)) * 6 >= max(1, len(w))
    count = lambda p: len(regex.findall(p, text))
    echoes = sum(a == b and regex.fullmatch(r"\p{L}+", b) is not None for a, b in zip(w, w[1:], strict=False))
    prose, short = (sum(regex.fullmatch(p, x) is not None for x in w) for p in (r"\p{L}+[.,;:?]?", r"\p{L}{1,3}[.,]?"))
    sentences = count(r"\p{Ll}[.?](?=[\x20\x09-\x0D]|\Z)")
    pick = lambda bad, good=False: 0 if bad else 1 if good else -1
    return (
        pick(count(r"[#*$%&|<>]") * 25 > size), pick(count(r"\|") * 5 > n), pick(count(r"\p{Lu}") * 2 > count(r"\p{L}")), pick(count("!") * 5 > n), pick(len(lines) > 3 and len(set(lines)) * 2 < len(lines)),
        pick(n >= 30 and not varied, n >= 30 and kinds * 5 > n * 2), pick(echoes * 6 > n), pick(prose * 10 < n * 7, prose * 10 > n * 9 and varied), pick(short * 12 < n, short * 4 > n and varied),
        pick(sentences * 100 < n, sentences * 25 > n), pick(count(r"[\p{P}\p{S}]") * 12 > size),
    )


def plain_features(text):
    """Words and shapes, as the scorer counts them, before hashing."""
    shape = lambda x: regex.sub(r"\p{Nd}", "0", regex.sub(r"\p{Ll}+", "a", regex.sub(r"\p{Lu}", "A", x)))
    w = brute.words(text)
    return Counter(w), Counter(map(shape, w))


def test_votes_and_scores_match_plain_versions(spark, monkeypatch):
    texts = [r[1] for r in rows()] + ["Go go go! Ab, cd; ef? 12 x1 A|b", "yes yes no.", "é. É? ß.\n\nx", "\u0662 a\u0301b.", "wort wort wort wort " * 9]
    drawn = spark.read.parquet(f"{DATA}/documents.parquet").select("text").collect()
    texts += [r.text for r in drawn]
    monkeypatch.setattr(words, "SLICE", 5000)
    votes = np.concatenate([part.votes for part in quality.read(pa.array(texts, pa.string()))])
    assert [tuple(v) for v in votes.tolist()] == [plain_votes(t) for t in texts]
    code = quality._code(votes)
    assert (quality._votes_of(code) == votes).all()
    for part in quality.read(pa.array(texts, pa.string())):
        for k, (a, b) in enumerate(zip(part.bounds[:-1], part.bounds[1:], strict=True)):
            w, shapes = plain_features(texts[part.first + k])
            assert b - a == 2 * sum(w.values())
            assert len(set(part.features[a:b].tolist())) <= len(w) + len(shapes)
    docs = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string").repartition(3)
    scorer = quality.fit(docs)
    got = {r.doc_id: r for r in quality.score(docs, scorer).collect()}
    for i, t in enumerate(texts):
        if not brute.words(t):
            assert (got[i].posterior, got[i].score, got[i].kept) == (0, 0, False)
            continue
        gap = np.log(scorer.weak.prior / (1 - scorer.weak.prior)) + sum(np.log(g[v] / b[v]) for v, g, b in zip(plain_votes(t), scorer.weak.good, scorer.weak.bad, strict=True))
        assert got[i].posterior == pytest.approx(1 / (1 + np.exp(-gap)))
        own = next(iter(quality.read(pa.array([t])))).features.tolist()
        counts = Counter(own)
        z = scorer.linear.bias + sum(n * scorer.linear.weights[f] for f, n in counts.items()) / np.sqrt(sum(n * n for n in counts.values()))
        assert got[i].score == pytest.approx(1 / (1 + np.exp(-z)))
        assert got[i].kept == (got[i].score >= 0.5)


def test_quality_classifier_agrees_with_the_labels(spark):
    d = DATA.replace("0.001", "0.01")
    docs = spark.read.parquet(f"{d}/documents.parquet")
    got = quality.score(docs, quality.fit(docs)).join(spark.read.parquet(f"{d}/labels.parquet"), "doc_id").collect()
    assert np.mean([r.kept == (r.quality == 1) for r in got]) > 0.9
    odd = quality.score(frame(spark), quality.fit(frame(spark))).collect()
    assert len(odd) == len(rows())
    assert sum(r.score == 0 and not r.kept for r in odd) >= 4
    empty = frame(spark, []).where("false")
    assert quality.score(empty, quality.fit(empty)).collect() == []


def test_language_on_held_out_documents(spark):
    got = queries.op4_language_id(spark, DATA.replace("0.001", "0.01"))
    docs = spark.read.parquet(f"{DATA.replace('0.001', '0.01')}/documents.parquet").select("doc_id", "lang", "text")
    both = got.join(docs, "doc_id").where("held_out and lang is not null").collect()
    assert np.mean([r.lang_pred == r.lang for r in both if any(map(str.isalpha, r.text or ""))]) > 0.97
    assert all(0 <= r.score <= 1 for r in both)


def test_language_cases(spark):
    table = rows()
    df = frame(spark, table)
    model = language.learn(df.select("doc_id", "lang", "text"))
    assert model.languages == ["de", "en"]
    got = language.predict(df, model).collect()
    text_of = {r[0]: r[1] for r in table}
    assert len(got) == len(table)
    for r in got:
        if r.doc_id is not None:
            assert (r.lang_pred == "und") == (not any(map(str.isalpha, text_of[r.doc_id] or "")))
    nothing = language.learn(df.where("false").select("doc_id", "lang", "text"))
    assert {r.lang_pred for r in language.predict(df, nothing).collect()} == {"und"}
    assert language.predict(df.where("false"), model).collect() == []


class PlainKneserNey:
    """Interpolated Kneser-Ney over characters, by counting in dictionaries."""

    def __init__(self, texts, order=4):
        self.order, counts = order, Counter()
        for t in texts:
            s = self.symbols(t)
            counts.update(tuple(s[i : i + order]) for i in range(len(s) - order + 1))
        self.levels = [counts]
        while len(self.levels) < order:  # a lower order counts the characters that stand before a gram
            self.levels.insert(0, Counter(g[1:] for g in self.levels[0]))
        self.discounts, self.contexts = [], []
        for level in self.levels:
            once, twice = (sum(n == k for n in level.values()) for k in (1, 2))
            self.discounts.append(once / (once + 2 * twice) if once and twice else 0.5)
            held = {}
            for g, n in level.items():
                total, kinds = held.get(g[:-1], (0, 0))
                held[g[:-1]] = total + n, kinds + 1
            self.contexts.append(held)

    @staticmethod
    def symbols(text):
        """Lower-case letters and marks; one border for each run of anything else, three before the text and one after it."""
        out = [0, 0, 0]
        for c in text:
            keep = c.isalpha() or unicodedata.category(c) in ("Mn", "Mc")
            if keep or out[-1]:
                out.append(ord(c.lower()[0]) if keep else 0)
        return [*out, 0]

    def probability(self, gram):
        p = 2.0**-language.BITS
        for k in range(1, self.order + 1):
            own = tuple(gram[-k:])
            total, kinds = self.contexts[k - 1].get(own[:-1], (0, 0))
            if total:
                n, d = self.levels[k - 1].get(own, 0), self.discounts[k - 1]
                p = max(n - d, 0) / total + d * kinds / total * p
        return p

    def entropy(self, text):
        s = self.symbols(text)
        return -np.mean([np.log(self.probability(s[i : i + self.order])) for i in range(len(s) - self.order + 1)])


def test_predictions_match_a_plain_model(spark):
    docs = spark.read.parquet(f"{DATA}/documents.parquet").select("doc_id", "lang", "text")
    held = docs.collect()
    learnt, asked = [r for r in held if r.doc_id % 4], [r.text[:600] for r in held if not r.doc_id % 4][:25] + ["\u0436\u0448 a", "x", "Ab, cd"]
    model = language.learn(docs.where("doc_id % 4 <> 0"))
    plain = {x: PlainKneserNey([r.text for r in learnt if r.lang == x]) for x in model.languages}
    want = np.array([[plain[x].entropy(t) for x in model.languages] for t in asked])
    assert np.allclose(model.entropies(asked), want, atol=2e-3)
    table = spark.createDataFrame(list(enumerate(asked)), "doc_id long, text string").repartition(2)
    for r in language.predict(table, model).collect():
        h = want[r.doc_id]
        assert r.lang_pred == model.languages[int(h.argmin())] or np.sort(h)[1] - h.min() < 4e-3
        assert r.score == pytest.approx(1 / np.exp(-model.sharpness * (h - h.min())).sum(), abs=0.05)


def test_kneser_ney_is_a_distribution(spark):
    """Over the characters met after a context, and the share that is left for all others."""
    docs = spark.createDataFrame([(1, "en", "the theory then there"), (2, "de", "der die das dort dann")], "doc_id long, lang string, text string")
    model = language.learn(docs)
    code = lambda s: [0 if c == " " else ord(c) for c in s]
    for context in ("   ", " th", "the", "xyz", " da"):
        first, a, b = code(context)
        keys = np.array([a << 2 * language.BITS | b << language.BITS | c for c in (0, *range(97, 123))], dtype=np.int64)
        own = np.exp(model._log(keys, language.ORDER, np.full(len(keys), first)).astype(float)).sum(axis=0)
        other = np.exp(model._log(np.array([keys[0] | 0x4E00]), language.ORDER, np.array([first])).astype(float))[0]
        assert np.allclose(own + other * ((1 << language.BITS) - len(keys)), 1, atol=1e-3)


def test_languages_of_one_script_are_told_apart(spark):
    """Letters that fell on one of five symbols, and words that differ by vowel signs alone."""
    old = lambda c: (ord(c) * 0x9E3779B1 >> 7) % 5
    letters = {k: [c for c in map(chr, range(0x430, 0x450)) if old(c) == k] for k in range(5)}
    pairs = [(own[i], own[i + 1]) for own in letters.values() for i in range(0, len(own) - 1, 2)]
    rng = random.Random(4)
    text = lambda side: " ".join("".join(rng.choice(pairs)[side] for _ in range(5)) for _ in range(12))
    sign = lambda s: " ".join(rng.choice("\u0915\u0916\u0917\u0918") + s for _ in range(12))
    table = [(i, lang, t) for i, (lang, t) in enumerate((lang, t) for _ in range(20) for lang, t in (("bg", text(0)), ("ru", text(1)), ("hi", sign("\u093f")), ("mr", sign("\u093e"))))]
    docs = spark.createDataFrame(table, "doc_id long, lang string, text string").repartition(3)
    model = language.learn(docs.where("doc_id < 60"))
    got = {r.doc_id: r.lang_pred for r in language.predict(docs, model).collect()}
    assert got == {i: lang for i, lang, _ in table}


def test_gathered_grams_grow_with_the_letters(spark, monkeypatch):
    monkeypatch.setattr(language, "PART", 7)
    texts = ["".join(map(chr, range(0x4E00 + k, 0x4E00 + k + 300))) for k in (0, 300)] + ["x" + chr(0x20000 + k) + "a" for k in range(60)]
    docs = spark.createDataFrame([(i, "zh", t) for i, t in enumerate(texts)], "doc_id long, lang string, text string")
    want = Counter()
    for t in texts:
        s = [0, 0, 0, *map(ord, t), 0]
        want.update(tuple(s[i : i + 4]) for i in range(len(s) - 3))
    bits = language.BITS
    got = {(r.first, r.key >> 2 * bits, r.key >> bits & (1 << bits) - 1, r.key & (1 << bits) - 1): r.n for r in language.gram_counts(docs).collect()}
    assert got == want


def test_tables_of_many_files_give_the_same(spark, monkeypatch):
    df = frame(spark, rows()).select("doc_id", "lang", "text")
    texts = [t for _, t, *_ in rows()[:40] if t]
    want = language.learn(df).entropies(texts)
    monkeypatch.setattr(language, "FILE", 50)
    model = language.learn(df)
    assert len(model.tables[3][0].files) > 8
    assert np.allclose(model.entropies(texts), want, atol=1e-5)


@pytest.mark.parametrize("wrong", [5, 4000])
def test_scores_are_calibrated_on_all_learning_documents(spark, wrong):
    """Against plain figures over every row: more rows than a sample of 2000, ids repeated or null; many labels wrong, or one."""
    rng = random.Random(8)
    letters = {"aa": "abcdefg", "bb": "cdefghi", "cc": "efghijk"} if wrong == 5 else {"aa": "abcdef", "bb": "defghi", "cc": "jklmno"}
    table = []
    for i in range(4000):
        lang = rng.choice(list(letters))
        text = " ".join("".join(rng.choices(letters[lang], k=rng.randint(2, 6))) for _ in range(rng.randint(1, 6) if wrong == 5 else 20))
        table.append((None if i % 10 == 0 else 7 if i % 10 == 1 else i, rng.choice(list(letters)) if i % wrong == 1 else lang, text))
    table += [(5000, "aa", "1 2"), (5001, "aa", ""), (5002, None, "x" * 50), (5003, "bb", None)] + [(6000 + i, "cc", "\u0436\u0448" * (i + 1)) for i in range(8)]
    docs = spark.createDataFrame(table, "doc_id long, lang string, text string").repartition(5)
    model = language.learn(docs)
    own = [(x, t) for _, x, t in table if x and t and any(map(str.isalpha, t))]
    h = model.entropies([t for _, t in own])
    over = h - h.min(axis=1, keepdims=True)
    at = [model.languages.index(x) for x, _ in own]
    fit = {s: np.mean(-s * over[np.arange(len(at)), at] - np.log(np.exp(-s * over).sum(axis=1))) for s in (2.0**k for k in range(-1, 8))}
    assert model.sharpness == max(fit, key=fit.get)
    assert model.most == pytest.approx(np.quantile(h.min(axis=1), 0.999) * 1.1, abs=1e-9)
    again = language.learn(docs.repartition(3))
    assert (again.sharpness, again.most) == (model.sharpness, model.most)


def test_ranks_in_bins(spark):
    rng = random.Random(9)
    values = [0, 0, (1 << 48) - 1, 1 << 47] + [rng.randrange(1 << rng.randint(1, 47)) for _ in range(60)] + [77] * 9
    table = spark.createDataFrame([(v,) for v in values], "v long").repartition(3)
    for rank in (1, 2, 3, 30, 31, 72, 73):
        assert language._ranked(table, "v", rank) == sorted(values)[rank - 1]


URLS = ["http://Example.NET/en/x?q=1#f", "https://sub.example.net/de/", "ftp://example.com/de/a#b", "http://a.example.com/dex", "HTTP://x.org/fr/", "http://notexample.com/de/", None, "", "no scheme", "a://", "://net/", "http://net", "http://evil.net#/x", "http://a.net?x/y", "x://y://z.net/en/", "http://ÜBER.net/", "http://example.net/en", "http:///en/", "a\n://b.net/x\ny"]


def plain_verdict(url):
    rules = {("net", "/"): "block", ("example.net", "/en/"): "allow", ("example.com", "/de/"): "block", ("org", "/fr/"): "allow"}
    if url is None or "://" not in url:
        return "", "", None, "allow"
    rest = url.split("://", 1)[1]
    cut = min([rest.find(c) for c in "/?#" if c in rest], default=len(rest))
    host, rest = rest[:cut].translate(brute.LOWER), rest[cut:]
    path = rest[: min([rest.find(c) for c in "?#" if c in rest], default=len(rest))]
    fits = [(len(h + p), h + p, v) for (h, p), v in rules.items() if ("." + host).endswith("." + h) and path.startswith(p)]
    return host, path, *(max(fits)[1:] if fits else (None, "allow"))


@pytest.mark.parametrize("most", [2_000_000, 0])
def test_long_hosts_and_paths_of_many_lengths(spark, most):
    """A host of many labels costs what a short one does, and rules of 1,200 path lengths are all known."""
    rules = [("a.b.net", "/" + "x" * n, "block" if n % 2 else "allow") for n in range(1200)] + [("a.com", "", "block"), ("a.co", "m", "allow")]
    table = [(1, "http://" + "q." * 20_000 + "a.b.net/" + "x" * 700), (2, "http://a.com"), (3, "http://a.b.net/" + "x" * 5000), (4, "http://b.net/x")]
    df = spark.createDataFrame(table, "page_id long, url string")
    got = {r.page_id: (r.rule and len(r.rule), r.verdict) for r in urls.judge(df, spark.createDataFrame(rules, "host string, path string, verdict string"), most_rules=most).collect()}
    assert got == {1: (8 + 700, "allow"), 2: (5, "block"), 3: (8 + 1199, "block"), 4: (None, "allow")}


@pytest.mark.parametrize("most", [2_000_000, 0])
def test_url_rules(spark, most):
    rules = spark.createDataFrame([*queries.URL_RULES, queries.URL_RULES[0], ("x.y", None, "block")], "host string, path string, verdict string")
    df = spark.createDataFrame([(i, u, "clash") for i, u in enumerate([*URLS, URLS[0]])], "page_id long, url string, host string").repartition(2)
    got = urls.judge(df, rules, most_rules=most).collect()
    assert len(got) == len(URLS) + 1
    for r in got:
        assert (r.host, r.path, r.rule, r.verdict) == plain_verdict(r.url), r
    assert urls.judge(df.where("false"), rules, most_rules=most).collect() == []
    assert {r.verdict for r in urls.judge(df, rules.where("false"), most_rules=most).collect()} == {"allow"}


def test_equal_digests_are_told_apart_by_their_strings(tmp_path, monkeypatch):
    monkeypatch.setattr(urls.xxhash, "xxh3_64_intdigest", lambda text: 7)
    urls.DigestArray.write({"a/": "allow", "b/": "block"}, f"{tmp_path}/r")
    assert urls.DigestArray(f"{tmp_path}/r").probe(["b/", "a/", "c/"]) == ["b", "a", None]


@pytest.mark.parametrize("name", sorted(queries.oracle_sql()))
def test_sql_gives_the_same(spark, name):
    con = duckdb.connect()
    for t in ("documents", "pages"):
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{DATA}/{t}.parquet')")
    df = queries.queries()[name](spark, DATA)
    want = con.execute(f"SELECT {', '.join(df.columns)} FROM ({queries.oracle_sql()[name]})").fetchall()
    key = lambda r: tuple(str(x) for x in r)
    assert sorted(map(key, df.collect())) == sorted(map(key, want))
