"""Token counts, quality, licences, fingerprints, languages, mixing, decontamination."""

import hashlib
import math
import random
import re
from collections import Counter

import numpy as np
import pyarrow as pa
import pytest
from corpus import LOWER, WORD, best_edits, documents, table
from tessera.llm import decontaminate, fingerprints, language, licenses, mixing, quality, token_counts
from pyspark.sql import functions as F
from tessera.llm.arrays import utf8


def collected(df, key="doc_id"):
    return {r[key]: r for r in df.collect()}


# --- token counts


def brute_tokens(data: bytes, logp: dict) -> tuple[int, float]:
    best = [(0.0, 0)] + [(-math.inf, 0)] * len(data)
    for i in range(1, len(data) + 1):
        for j in range(i - 1, -1, -1):
            s = logp.get(data[j:i])
            if s is not None and best[j][0] + s > best[i][0]:
                best[i] = (best[j][0] + s, best[j][1] + 1)
    return best[-1][1], best[-1][0]


@pytest.mark.parametrize("nodes", [10, 400_000])
def test_token_counts_as_brute_force(spark, nodes):
    logp = {bytes([b]): -6.0 - b / 500 for b in range(256)} | {b"ab": -5.5, b" ab": -6.5, b"abc": -7.0, b"de": -6.2, b" one": -3.0}
    v = token_counts.Vocabulary(logp)
    docs, rows = documents(spark, 1, 40)
    import regex

    got = collected(token_counts.count_tokens(docs, v, nodes))
    for i, text, *_ in rows:
        found = regex.findall(v.pattern, text or "")
        n = [brute_tokens(p.encode(), logp) for p in found]
        assert (got[i].n_pretokens, got[i].n_distinct, got[i].n_tokens) == (len(found), len(set(found)), sum(x[0] for x in n))
        assert math.isclose(got[i].logp, sum(x[1] for x in n), rel_tol=1e-9, abs_tol=1e-9)
    assert token_counts.count_tokens(table(spark, []), v).collect() == []


def test_tokens_beyond_the_trie_as_brute_force(monkeypatch):
    """Long pre-tokens make no more nodes than DEPTH, and count as whole ones do."""
    logp = {bytes([b]): -6.0 - b / 500 for b in range(256)} | {b"ab": -5.5, b"abc": -7.0, b"cab": -6.2, b"abcabc": -9.0}
    r, trie = random.Random(1), token_counts.Trie(token_counts.Vocabulary(logp))
    monkeypatch.setattr(token_counts, "DEPTH", 20)
    for n in (3, 20, 21, 26, 27, 60, 500):
        text = "".join(r.choice("abcd") for _ in range(n))
        tokens, score = trie.insert(text)
        want = brute_tokens(text.encode(), logp)
        assert tokens == want[0] and math.isclose(score, want[1])
    assert len(trie.score) <= 1 + 7 * 20 and trie.insert("a" * 200_000)[0] == 200_000


def test_pretokens_in_arrays_as_the_regex(monkeypatch):
    """Rows are split as PATTERN does, however they are cut into pieces, and empty rows have none."""
    import regex

    r = random.Random(7)
    units = ["'", "'s", "'re", "'ve", "'ll", "'m", "'d", "'t", " ", "  ", "\n", "\t", "\u00a0", "\u3000", "\x1c", "\x85", "\0", "a", "s", "l", "v", "e", "é", "1", "²", ".", "!", "🙂", "中", "\u0301"]
    for piece in (1, 7, 1 << 20):
        monkeypatch.setattr(token_counts, "PIECE", piece)
        for _ in range(300):
            rows = ["".join(r.choices(units, k=r.choice([0, 1, 2, 5, 30]))) for _ in range(r.choice([1, 3, 8]))]
            for pattern in (token_counts.PATTERN, r"\w+"):
                found, each = token_counts.pretokens(*utf8(pa.array([None, *rows])), pattern)
                want = [regex.findall(pattern, x) for x in ["", *rows]]
                assert each.tolist() == [len(x) for x in want]
                assert [x.decode() for x in found.to_pylist()] == [x for row in want for x in row]


@pytest.mark.parametrize("most", [0, 3000, 400_000])
def test_nodes_are_made_together(monkeypatch, most):
    """A block's pre-tokens cost a step for each depth, not one for each byte, and count as those inserted alone."""
    logp = {bytes([b]): -6.0 - b / 500 for b in range(256)} | {b"ab": -5.5, b"abc": -7.0, b"cab": -6.2, b"abcabc": -9.0, b"b\xc3\xa9": -8.0, b"aa": -12.4}
    v, r = token_counts.Vocabulary(logp), random.Random(2)
    found = [" ".join("".join(r.choices("abcé", k=r.choice([1, 3, 8, 20]))) for _ in range(1000)) for _ in range(3)]
    rows = [*found, None, "a" * 300 + "b", found[0]]
    import regex

    alone, trie, steps = token_counts.Trie(v), token_counts.Trie(v), []
    before = trie.endings.before
    monkeypatch.setattr(trie.endings, "before", lambda *x: steps.append(1) or before(*x))
    for block in ([0, 1], [2], [3, 4], [5]):
        flat, at = utf8(pa.array([rows[i] for i in block], pa.string()))
        got = token_counts._counted(trie, flat, at, v.pattern, most)
        for k, i in enumerate(block):
            each = Counter(regex.findall(v.pattern, rows[i] or ""))
            n = {p: alone.insert(p) for p in each}
            assert all(n[p][0] == brute_tokens(p.encode(), logp)[0] for p in list(n)[:50])
            assert tuple(x[k] for x in got[:3]) == (each.total(), len(each), sum(n[p][0] * each[p] for p in each))
            assert math.isclose(got[3][k], sum(n[p][1] * each[p] for p in each), rel_tol=1e-12)
    assert len(steps) <= 4 * 41 * 6 and len(trie.score) <= 1 + token_counts.DEPTH  # 41 bytes at most of all but one, and six of a piece


@pytest.mark.parametrize("pattern", [token_counts.PATTERN, r"\w+"])
def test_a_row_above_a_block_counts_as_whole(monkeypatch, pattern):
    r, logp = random.Random(3), {bytes([b]): -6.0 for b in range(256)} | {b" ab": -3.0, b"ab": -4.0}
    trie = token_counts.Trie(token_counts.Vocabulary(logp, pattern))
    text = "".join(r.choices([" ab", "ab", " \n", "é", "1", "'s"], k=3000)) + " " + "x" * 500 + " ab \n"
    flat, at = utf8(pa.array([text]))
    whole = token_counts._counted(trie, flat, at, pattern, 400_000)
    for piece in (16, 100, 5000):
        monkeypatch.setattr(token_counts, "BLOCK", 1000)
        monkeypatch.setattr(token_counts, "PIECE", piece)
        trie.clear()
        assert [x.tolist() for x in token_counts._counted(trie, flat, at, pattern, 400_000)] == [x.tolist() for x in whole]


def test_vocabulary_from_ranks(tmp_path):
    path = tmp_path / "v"
    path.write_text("YQ== 0\nYWI= 1\n")
    v = token_counts.Vocabulary.from_ranks(str(path))
    assert v.logp[b"a"] > v.logp[b"ab"] > v.logp[b"z"] and len(v.logp) == 257


# --- quality


def rated(spark, n=600):
    r = random.Random(3)
    words = [f"w{k}" for k in range(60)]
    docs, labels = [], []
    for i in range(n):
        kind = i % 3
        text = [r.choice(words) for _ in range(40)]
        if kind == 0:
            text[5] = "awfulword"
        if kind == 1:
            text = [f"{x}$$$" for x in text]
        docs.append((i, " ".join(text), "en", "s"))
        labels.append((i, 0 if kind == 1 else 1, 1 if kind == 0 else 0))
    return table(spark, docs), spark.createDataFrame([*labels, (None, 1, 1), (3, None, 0), (5, 1, None), (0, 1, 1)], "doc_id long, quality int, toxic int")


def test_quality_on_held_out_rows(spark):
    docs, labels = rated(spark)
    model = quality.fit(docs, labels.where("doc_id < 450 OR doc_id IS NULL"))
    assert model.thresholds[0] < model.thresholds[1]
    got = collected(quality.classify(docs.where("doc_id >= 450"), model))
    right = sum(g.kept == (i % 3 == 2) for i, g in got.items())
    assert len(got) == 150 and right >= 147
    assert all(abs(g.expected_grade - g.p_above_0 - g.p_above_1) < 1e-5 and g.p_above_0 >= g.p_above_1 for g in got.values())


def test_quality_fit_is_bounded_and_edge_rows(spark):
    docs, labels = rated(spark, 120)
    assert quality.fit(docs, labels, rows=50).thresholds is not None
    odd = table(spark, [(1, None, None, None), (1, None, None, None), (None, "", None, None), (2, "w1 " * 5000, None, None)])
    model = quality.fit(docs, labels)
    assert len(quality.classify(odd, model).collect()) == 4
    none = quality.fit(docs, labels.where("false"))
    assert none.thresholds is None and all(r.kept and r.expected_grade is None for r in quality.classify(odd, none).collect())
    assert quality.select(odd, none).count() == 4
    assert quality.classify(table(spark, []), model).collect() == []


def likelihood(w, thresholds, rows, y, l2):
    """The mean log likelihood of cumulative links, less the ridge, said plainly."""
    cdf = lambda x: 1 / (1 + math.exp(-x))
    total = 0.0
    for f, k in zip(rows, y):
        s = sum(w[x] for x in f)
        below = [0.0, *(cdf(t - s) for t in thresholds), 1.0]
        total += math.log(below[k + 1] - below[k])
    return total / len(y) - l2 / 2 * sum(x * x for x in w.values())


def test_fit_is_the_likeliest():
    """No step from what is fitted, of a weight or a threshold, is likelier; tails are those of the plain formula."""
    r = random.Random(5)
    rows = [sorted(r.sample(range(1, 9), 3)) for _ in range(240)]
    y = [min(2, max(0, round((3 in f) + (5 in f) - (7 in f) * 0.6 + r.gauss(0.6, 0.5)))) for f in rows]
    f, at = np.array([x for row in rows for x in row], np.int32), np.arange(0, 3 * len(rows) + 1, 3)
    l2 = 1e-2
    model = quality.fit_arrays(f, at, np.array(y), l2=l2, steps=3000, rate=0.02)
    w = {k: float(model.weights[k]) for k in range(1, 9)}
    best = likelihood(w, model.thresholds, rows, y, l2)
    for k in w:
        for step in (-0.03, 0.03):
            assert likelihood(w | {k: w[k] + step}, model.thresholds, rows, y, l2) < best
    for k in range(2):
        for step in (-0.03, 0.03):
            moved = [t + step * (i == k) for i, t in enumerate(model.thresholds)]
            assert likelihood(w, moved, rows, y, l2) < best
    tails = model.tails(f, at)
    for row, got in zip(rows, tails):
        s = sum(w[x] for x in row)
        assert all(math.isclose(g, 1 - 1 / (1 + math.exp(-(t - s))), abs_tol=1e-6) for t, g in zip(model.thresholds, got))


def test_quality_keeps_any_columns(spark):
    """Columns named as figures, nulls, repeated rows and empty tables."""
    docs, labels = rated(spark, 120)
    model = quality.fit(docs, labels)
    names = ["kept", "expected_grade", "p_above_0", "p_above_1", "grade", "id"]
    odd = docs.select("*", *[F.lit(1).alias(n) for n in names]).unionByName(table(spark, [(None, None, None, None)] * 2).select("*", *[F.lit(1).alias(n) for n in names]))
    figures = quality.classify(odd, model).collect()
    assert quality.select(odd, model).columns == odd.columns
    assert quality.select(odd, model).count() == sum(x.kept for x in figures) and len(figures) == 122
    assert quality.fit(odd, labels).thresholds is not None and quality.select(odd.where("false"), model).count() == 0


# --- licences


def brute_base(text):
    words = re.findall(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+", (text or "").translate(LOWER))
    places = [(k, label) for phrase, label in licenses.BASE.items() for p in [phrase.split()] for k in range(len(words) - len(p) + 1) if words[k : k + len(p)] == p]
    return len(words), len(places), min(places, default=(None,))[0], max(places, default=(None,))[0], ",".join(sorted({x for _, x in places}))


def test_license_places_as_brute_force(spark):
    phrases = [*licenses.BASE]
    texts = ["Under the MIT License, under the mit-license!", "x " * 9 + phrases[1].upper() + " " + phrases[1], "cc-by-nc CC BY NC", "under the mit", "apache license\nversion 2.0", None, "", "é under the mit licenseé", phrases[0] * 2, "cc by nc " * 3000]
    docs = table(spark, [(i * 2, t, None, None) for i, t in enumerate(texts)] + [(0, texts[0], None, None), (None, phrases[0], None, None)])
    rows = licenses.scan(docs).collect()
    got = {r.doc_id: r for r in rows}
    assert len(rows) == len(texts) + 2 and sum(r == got[0] for r in rows) == 2
    for i, t in enumerate(texts):
        g = got[i * 2]
        assert (g.n_words, g.n_base, g.first_word, g.last_word, g.base_labels) == brute_base(t)
        assert set(g.base_labels.split(",")) <= set(g.labels.split(",")) | {""} and 0 <= g.score <= 1
    assert got[None].labels == "mit"


def test_licences_by_diagonals(spark):
    bsd = next(k for k, v in licenses.TEMPLATES.items() if v == "bsd").split()
    gap = [*bsd[:9], "really", *bsd[9:]]
    turned = [*bsd[12:], *bsd[:12]]  # all its words, out of order
    got = collected(licenses.scan(table(spark, [(1, " ".join(gap), None, None), (2, " ".join(bsd[:8]), None, None), (3, "no " + " ".join(bsd), None, None), (4, " ".join(turned), None, None)])))
    assert got[1].labels == "bsd" and got[1].score == 1 and got[2].labels == "" and got[2].score == 0 and got[3].score == 1 and got[4].labels == ""
    assert licenses.scan(table(spark, [])).collect() == []


def subsequence(a, b):
    row = [0] * (len(b) + 1)
    for x in a:
        new = [0]
        for j, y in enumerate(b, 1):
            new.append(max(row[j], new[-1], row[j - 1] + (x == y)))
        row = new
    return row[-1]


def test_versions_and_shares_as_brute_force(spark):
    """Labels and scores of one passage a document are those of the passages with most words in order, by comparing all."""
    r = random.Random(3)
    rows = []
    for i in range(60):
        words = r.choice([*licenses.TEMPLATES]).split()
        for _ in range(r.randrange(5)):
            p = r.randrange(len(words))
            words[p : p + 1] = r.choice([[], ["other"], [words[p], "more"]])
        rows.append((i, " ".join(["lead"] * r.randrange(4) + words + ["tail"] * r.randrange(4)), None, None))
    got, right = collected(licenses.scan(table(spark, rows), base={})), 0
    for i, text, *_ in rows:
        shares = {p: subsequence(p.split(), text.split()) / len(p.split()) for p in licenses.TEMPLATES}
        top = max(shares.values())
        if top >= 0.9:
            best = max(len(p.split()) for p, s in shares.items() if s == top)
            assert got[i].labels == ",".join(sorted({licenses.TEMPLATES[p] for p, s in shares.items() if s == top and len(p.split()) == best})) and math.isclose(got[i].score, top)
            right += 1
    assert right > 30
    for version in ("gpl-2", "gpl-3", "cc-by", "cc-by-sa", "cc-by-nc"):
        text = next(k for k, v in licenses.TEMPLATES.items() if v == version)
        assert licenses.scan(table(spark, [(1, f"a {text} z", None, None)]), base={}).first().labels == version


# --- fingerprints


def test_fingerprints_of_edits(spark):
    docs, rows = documents(spark, 1, 60)
    got = collected(fingerprints.fingerprint_edits(docs))
    ordered = sorted(rows, key=lambda x: -1 if x[0] is None else x[0])
    seen = {}
    for k, (i, text, *_) in enumerate(ordered):
        text, after = text or "", ordered[(k + 1) % len(ordered)][1] or ""
        half = len(text) // 2
        edited = text[: len(text) - half] + after[:half]
        assert got[i].n_chars == len(text) and got[i].edited_sha256 == hashlib.sha256(edited.encode()).hexdigest()
        assert seen.setdefault(text, got[i].fingerprint) == got[i].fingerprint
        assert seen.setdefault(edited, got[i].edited_fingerprint) == got[i].edited_fingerprint
        assert 0 <= got[i].near_edited <= 1 and 0 <= got[i].near_next <= 1
    assert len({*seen.values()}) == len(seen)


def test_fingerprints_are_local_and_alone(spark):
    r = random.Random(2)
    body = " ".join("".join(r.choice("abcdefgh") for _ in range(5)) for _ in range(900))
    texts = [body, "shifted by this " + body, " ".join("".join(r.choice("abcdefgh") for _ in range(5)) for _ in range(900))]
    a, b, c = fingerprints.sketches([t.encode() for t in texts])[1]
    like = lambda x, y: float(fingerprints.likeness(x[None], y[None])[0])
    assert like(a, b) > 0.9 and like(a, c) < 0.3 and like(a, a) == 1
    one = fingerprints.fingerprint_edits(table(spark, [(5, "abc def", None, None)])).first()
    assert one.near_next == 1 and one.edited_sha256 == hashlib.sha256(b"abc abc").hexdigest()
    assert fingerprints.fingerprint_edits(table(spark, [])).collect() == []
    same = fingerprints.fingerprint_edits(table(spark, [(5, "a", None, None), (5, "a", None, None), (5, None, None, None)])).collect()
    assert len(same) == 3
    assert {r.fingerprint for r in fingerprints.fingerprint(table(spark, [(1, "abc def", None, None)])).collect()} == {one.fingerprint}


def test_likeness_is_near_that_of_whole_phrase_sets(spark):
    """Dice's coefficient of the sets of phrases of levels 2 and 3, taken whole, against what 128 bins say; spans of one parse."""
    r = random.Random(7)
    body = ["".join(r.choice("abcdefgh") for _ in range(5)) for _ in range(1500)]
    texts = []
    for share in (0, 0.05, 0.2, 0.5, 0.9):
        texts.append(" ".join(w if k >= share * 1500 else w[::-1] + "x" for k, w in enumerate(body)).encode())

    def whole(t):
        return {(level, int(x)) for level, names, _ in fingerprints.phrases([t]) if level in (2, 3) for x in names}

    sets, sketches = [whole(t) for t in texts], fingerprints.sketches(texts)[1]
    for k in range(1, len(texts)):
        exact = 2 * len(sets[0] & sets[k]) / (len(sets[0]) + len(sets[k]))
        assert abs(fingerprints.likeness(sketches[:1], sketches[k : k + 1])[0] - exact) < 0.15
    assert whole(b"abc") == {(2, x) for level, names, _ in fingerprints.phrases([b"abc"]) if level == 2 for x in map(int, names)} | {(3, x) for level, names, _ in fingerprints.phrases([b"abc"]) if level == 3 for x in map(int, names)}


def test_fingerprints_of_long_texts_in_pieces(monkeypatch):
    r = random.Random(8)
    long = "".join(r.choice("abcdefgh ") for _ in range(30_000)).encode()
    one = fingerprints.sketches([long])
    monkeypatch.setattr(fingerprints, "PIECE", 4_000)
    cut, again = fingerprints.sketches([b"x", long, b"", long]), fingerprints.sketches([long])
    assert (cut[1][1] == cut[1][3]).all() and cut[0][1] == cut[0][3] == again[0][0] and (again[1][0] == cut[1][1]).all()
    assert fingerprints.likeness(one[1], again[1])[0] > 0.95 and len(set(cut[0].tolist())) == 3


def test_rows_of_one_id_are_spread_over_blocks(spark):
    docs = table(spark, [(None, f"text {k}", None, None) for k in range(300)] + [(7, "end", None, None)])
    blocks = fingerprints.in_order(docs).where("NOT copy").select("block").distinct().count()
    assert blocks >= 3 and fingerprints.fingerprint_edits(docs).count() == 301


def test_labels_differ_between_neighbours():
    r = np.random.default_rng(1)
    for x in (r.integers(0, 255, 5000).astype(np.uint8), r.integers(0, 2**63, 5000).astype(np.uint64)):
        x = x[np.concatenate([[True], x[1:] != x[:-1]])]
        label = fingerprints.labels(x, np.array([0, 2000, len(x)]))
        assert label.max() < 6 and (np.diff(label[:2000].astype(int)) != 0).all() and (np.diff(label[2000:].astype(int)) != 0).all()


# --- language


def test_languages_on_held_out_rows(spark):
    r = random.Random(1)
    words = {"en": ["the", "and", "with", "this", "that"], "fr": ["le", "une", "avec", "été", "que"], "de": ["der", "und", "mit", "über", "ß"]}
    rows = [(i, " ".join(r.choice(words[lang]) for _ in range(12)), lang, None) for i in range(400) for lang in [["en", "fr", "de"][i % 3]]]
    odd = [(1004, "²½ ①", "fr", None), (1000, None, "en", None), (1001, "12 34", "fr", None), (1002, "", None, None), (None, "the and with", None, None), (1003, "été " * 9000, None, None), (1003, "x", None, None)]
    docs = table(spark, rows + odd)
    model = language.fit(docs.where(~language.held_out(docs)))
    got = language.identify(docs, model).collect()
    import zlib

    held = {i: zlib.crc32(str(i).encode()) % 3 == 1 for i, *_ in rows}
    truth = {i: lang for i, _, lang, _ in rows}
    assert all(g.held_out == held[g.doc_id] for g in got if g.doc_id in held)
    tested = [g for g in got if held.get(g.doc_id)]
    assert len(tested) > 80 and all(g.lang_pred == truth[g.doc_id] and 0 <= g.score <= 1 for g in tested)
    by = {g.doc_id: g for g in got}
    assert [by[k].lang_pred for k in (1000, 1001, 1002, 1004)] == ["und"] * 4 and by[None].lang_pred == "en" and len(got) == len(rows) + 7
    nothing = language.fit(docs.where("false"))
    assert {g.lang_pred for g in language.identify(docs, nothing).collect()} == {"und"} and nothing == []
    few = language.fit(docs.where(~language.held_out(docs)), languages=2)
    assert [m.langs for m in few] == [["de", "en"], ["fr"]]
    close = lambda rows: sorted((str(g.doc_id), g.lang_pred, round(g.score, 9)) for g in rows)
    assert close(language.identify(docs, few).collect()) == close(got)


def test_languages_as_plain_naive_bayes(spark):
    """Predictions and posteriors are those of counts in a dictionary."""
    r = random.Random(2)
    rows = [(i, "".join(r.choice({"a": "abcd é", "b": "bcde é", "c": "cdef à"}[x]) for _ in range(r.randint(5, 60))), x, None) for i in range(90) for x in [r.choice("abc")]]
    docs = table(spark, rows)
    got = collected(language.identify(docs, language.fit(docs)))
    hashed = lambda t: [int(x) for f, _ in language.features([t]) for x in f]
    counts = {x: Counter(g for _, t, y, _ in rows if y == x for g in hashed(t)) for x in "abc"}
    for i, text, *_ in rows:
        score = {}
        for x, c in counts.items():
            n = c.total() + 0.1 * 2**language.BITS
            score[x] = math.log(sum(y == x for _, _, y, _ in rows) / 90) + sum(math.log((c[g] + 0.1) / n) for g in hashed(text))
        best = max(score, key=lambda x: score[x])
        share = 1 / sum(math.exp(v - score[best]) for v in score.values())
        assert got[i].lang_pred == best and math.isclose(got[i].score, share, abs_tol=1e-3)


def test_trigrams_of_long_texts_in_pieces(monkeypatch):
    text = "Ein långer Text, é ist " * 40
    whole = [f.tolist() for f, _ in language.features([text])][0]
    for piece in (1, 2, 3, 100, len(text) - 1):
        monkeypatch.setattr(language, "PIECE", piece)
        assert [x for f, at in language.features([text]) for x in f.tolist()] == whole and len(whole) == len(text) + 2


# --- mixing


def filled(sizes: dict, weights=(5, 2, 1), share=1.5) -> dict:
    names = sorted((n for n in sizes if n is not None)) + [n for n in sizes if n is None]
    w = {n: weights[i % 3] for i, n in enumerate(names)}
    left, open_, out = share * sum(sizes.values()), set(names), {}
    while open_:
        level = left / sum(w[n] for n in open_)
        full = {n for n in open_ if w[n] * level > 2 * sizes[n]}
        if not full:
            return out | {n: w[n] * level for n in open_}
        out |= {n: 2 * sizes[n] for n in full}
        left -= sum(2 * sizes[n] for n in full)
        open_ -= full
    return out


@pytest.mark.parametrize("seed", [1, 2, 3, 4])
def test_targets_and_words_taken(spark, seed):
    r = random.Random(seed)
    names = ["b", "a", "Z", None, "é", "c", "d"]
    rows = [(i, " ".join(["w"] * r.choice([0, 1, 5, 300])), None, r.choice(names[: r.randint(1, 7)])) for i in range(200)] + [(7, "w w", None, "a"), (None, None, None, "a")]
    mixed = mixing.mix(table(spark, rows)).collect()
    again = mixing.mix(table(spark, rows[::-1])).collect()
    assert sorted(map(str, mixed)) == sorted(map(str, again)) and len(mixed) == len(rows)
    sizes = {}
    for _, t, _, s in rows:
        sizes[s] = sizes.get(s, 0) + len(WORD.findall(t or ""))
    want = filled(sizes)
    for s in sizes:
        own = [x for x in mixed if x.source == s]
        assert {x.source_size for x in own} == {sizes[s]} and all(math.isclose(x.target, want[s]) and 0 <= x.taken <= 2 * x.size for x in own)
        assert sum(x.taken for x in own) == math.floor(own[0].target)


def test_mix_is_what_finishes_first(spark):
    """Sorted by finish time and cut at the budget: all is taken before the cut and nothing after it."""
    rows = [(i, "w " * (i % 9 + 1), None, f"s{i % 3}") for i in range(100)]
    got = sorted(mixing.served(table(spark, rows)).collect(), key=lambda x: (x.finish, x.late))
    before = [x.taken == x.words for x in got]
    assert before == sorted(before, reverse=True) and all(x.taken in (0, x.words) for x in got)
    assert sum(x.taken for x in got) == sum(math.floor(t) for t in {x.source: x.target for x in got}.values())
    assert max(x.finish for x in got if x.taken) <= 1 < min(x.finish for x in got if not x.taken)
    plan = mixing.mix(table(spark, rows))._jdf.queryExecution().executedPlan().toString()
    assert "rangepartitioning(time" in plan
    assert mixing.mix(table(spark, [])).collect() == []


# --- decontamination


@pytest.mark.parametrize("block", [20_000, 2])
def test_leaks_as_brute_force(spark, monkeypatch, block):
    monkeypatch.setattr(decontaminate, "BLOCK_ITEMS", block)
    r = random.Random(6)
    say = lambda n: " ".join("".join(r.choice("abcdefg") for _ in range(r.randint(2, 6))) for _ in range(n))
    items = [(k, say(r.randint(6, 20))) for k in range(5)] + [(90, "short"), (91, None), (92, ""), (93, "a  B")]
    texts = [None, "", say(50), say(400), "not so SHORT a\nb", "shorter a bc", "b short"]
    for _ in range(40):
        s = list(r.choice(items[:5])[1])
        for _ in range(r.randint(0, 14)):
            p = r.randrange(len(s))
            s[p : p + 1] = r.choice([[], [r.choice("abcxyz")], [s[p], "q"]])
        texts.append(say(r.randint(0, 30)) + "\n " + "".join(s).upper() + "  " + say(r.randint(0, 30)))
    docs = table(spark, [(i, t, None, None) for i, t in enumerate(texts)] + [(None, texts[-1], None, None)])
    bench = spark.createDataFrame(items, "item_id long, text string")
    got = {(x.doc_id, x.item_id): x.edits for x in decontaminate.leaks(docs, bench).collect()}
    want = {}
    for i, t in [*enumerate(texts), (None, texts[-1])]:
        for k, item in items[:5]:
            item, most = decontaminate.normal(item), 0
            most = min(int(len(item) * 0.1), (len(item) - 8) // 8)
            if (n := best_edits(item, decontaminate.normal(t or ""))) <= most:
                want[i, k] = n
        for k, item in items[5:]:
            if item and f" {decontaminate.normal(item)} " in f" {decontaminate.normal(t or '')} ":
                want[i, k] = 0
    assert got == want and len(want) > 15
    kept = {x.doc_id for x in decontaminate.clean(docs, bench).collect()}
    assert kept == {i for i in [*range(len(texts)), None]} - {i for i, _ in want}
    assert decontaminate.leaks(docs, bench.where("false")).collect() == decontaminate.leaks(table(spark, []), bench).collect() == []


@pytest.mark.parametrize("shape", [(1 << 18, 1 << 20), (64, 50)])
def test_common_stems_in_bounded_memory(monkeypatch, shape):
    """Items with one stem against a text that repeats it: results as brute force, also in small pieces."""
    monkeypatch.setattr(decontaminate, "PIECE", shape[0])
    monkeypatch.setattr(decontaminate, "POSTINGS", shape[1])
    r = random.Random(4)
    stem = "which of the following is the best answer"
    items = [(k, f"{stem} {''.join(r.choice('abcdef ') for _ in range(r.choice([5, 20, 40])))}") for k in range(12)]
    odd = "  A\tb \n c" * 90 + " "
    assert decontaminate.normal(odd) == " ".join(odd.lower().split())
    texts = [f"{stem} " * 20, f"{stem} " * 3 + items[4][1].upper() + f" {stem}" * 9, "x" * 700 + items[7][1][:-1] + "y" * 200, items[2][1][4:], "z"]
    got = {(t, i): d for t, i, d, _ in decontaminate.Block(items, 0.1).search(texts)}
    want = {}
    for t, text in enumerate(map(decontaminate.normal, texts)):
        for k, item in items:
            item = decontaminate.normal(item)
            if (n := best_edits(item, text)) <= min(int(len(item) * 0.1), (len(item) - 8) // 8):
                want[t, k] = n
    assert got == want and len(want) > 3
    for t, k, d, end in decontaminate.Block(items, 0.1).search(texts):
        assert best_edits(decontaminate.normal(items[k][1]), decontaminate.normal(texts[t])[max(0, end - 120) : end]) == d


def test_utf8_of_nulls_and_slices():
    import pyarrow as pa

    flat, at = utf8(pa.array(["ab", None, "é", ""]).slice(1))
    assert at.tolist() == [0, 0, 2, 2] and flat.tobytes() == "é".encode()
    assert utf8(pa.array([], pa.string()))[1].tolist() == [0]
