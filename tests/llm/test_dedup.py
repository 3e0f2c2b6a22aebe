"""Suffix-array dedup, substring dedup and near-dedup against brute force."""

import numpy as np
import pytest
from corpus import byte_dedup, documents, near_groups, table, word_dedup
from hypothesis import given, settings
from hypothesis import strategies as st
from tessera.llm import common, near_dedup, repeats, substring_dedup, suffix_dedup
from tessera.llm.arrays import BYTE, Rolling
from tessera.llm.components import components
from tessera.llm.repeats import digests_of, merged, segments


@pytest.mark.parametrize("seed", [1, 2])
def test_bytes_as_brute_force(spark, seed):
    docs, rows = documents(spark, seed)
    got = {r.doc_id: (r.n_bytes, r.n_removed, r.n_spans, r.kept_sha256) for r in suffix_dedup.digests(docs).collect()}
    assert got == byte_dedup(rows)


@pytest.mark.parametrize("seed", [1, 2])
def test_words_as_brute_force(spark, seed):
    docs, rows = documents(spark, seed)
    got = {r.doc_id: (r.n_words, r.n_removed, r.kept_sha256) for r in substring_dedup.dedup(docs).collect()}
    assert got == word_dedup(rows)


@pytest.mark.parametrize("seed", [1, 2, 3])
def test_groups_as_brute_force(spark, seed):
    docs, rows = documents(spark, seed, 90)
    got = {r.doc_id: (r.n_shingles, r.component_id, r.kept) for r in near_dedup.near_duplicates(docs).collect()}
    assert got == near_groups(rows)


def test_near_copies_about_the_threshold(spark):
    """Many variants of one text, of which some are linked only through others: no link between components is lost."""
    r = np.random.default_rng(5)
    base = [f"w{k}" for k in range(120)]
    rows = []
    for i in range(150):
        words = list(base)
        for p in r.choice(120, r.integers(0, 7), replace=False):
            words[p] = f"v{r.integers(0, 40)}"
        rows.append((i, " ".join(words), "en", "s"))
    got = {x.doc_id: (x.n_shingles, x.component_id, x.kept) for x in near_dedup.near_duplicates(table(spark, rows)).collect()}
    assert got == near_groups(rows)


def test_groups_split_into_parts(spark, monkeypatch):
    monkeypatch.setattr(near_dedup, "STAR_ROWS", 3)
    monkeypatch.setattr(near_dedup, "GROUP_ROWS", 2)
    monkeypatch.setattr(common, "MOST_BROADCAST", 1)
    docs, rows = documents(spark, 4, 90)
    got = {r.doc_id: (r.n_shingles, r.component_id, r.kept) for r in near_dedup.near_duplicates(docs).collect()}
    assert got == near_groups(rows)


def test_hot_minimizers_change_nothing(spark, monkeypatch):
    monkeypatch.setattr(repeats, "SAMPLE", 1)
    monkeypatch.setattr(repeats, "HOT", 3)
    docs, rows = documents(spark, 3)
    assert len(repeats.hot(docs, repeats.Finder(32, 100, True, 4, suffix_dedup._units, suffix_dedup._codes, suffix_dedup._repeated))) > 0
    got = {r.doc_id: (r.n_bytes, r.n_removed, r.n_spans, r.kept_sha256) for r in suffix_dedup.digests(docs).collect()}
    assert got == byte_dedup(rows)
    got = {r.doc_id: (r.n_words, r.n_removed, r.kept_sha256) for r in substring_dedup.dedup(docs).collect()}
    assert got == word_dedup(rows)


def test_empty_tables(spark):
    docs = table(spark, [])
    assert suffix_dedup.digests(docs).collect() == substring_dedup.dedup(docs).collect() == near_dedup.near_duplicates(docs).collect() == []
    assert suffix_dedup.dedup(docs).columns == near_dedup.dedup(docs).columns == docs.columns


def test_repeated_rows_and_ids(spark):
    """Equal rows have equal results; texts of one id are ordered by their hash, and each result is that of its own text."""
    long = " ".join(f"word{k}" for k in range(60))
    docs = table(spark, [(1, long, None, None), (1, long, None, None), (1, long + " tail", None, None), (2, long, None, None)])
    got = sorted((r.doc_id, r.n_bytes, r.n_removed) for r in suffix_dedup.digests(docs).collect())
    n = len(long)
    assert [x[:2] for x in got] == [(1, n), (1, n), (1, n + 5), (2, n)] and got[0] == got[1] and got[3][2] == n
    assert {got[0][2], got[2][2]} in ({0, n}, {0})
    words = sorted((r.doc_id, r.n_removed) for r in substring_dedup.dedup(docs).collect())
    assert words == [(1, 0), (1, 0), (1, 0), (2, 60)]
    assert {(r.doc_id, r.component_id) for r in near_dedup.near_duplicates(docs).collect()} == {(1, 1), (2, 1)}


def test_equal_rows_stay_whole(spark):
    """Two equal rows alone lose nothing, also where their segments meet others with one minimizer; what a text repeats of itself goes from both."""
    long, own = " ".join(f"word{k}" for k in range(60)), " ".join(f"own{k}" for k in range(60))
    for rows in ([(1, long)] * 2, [(1, long)] * 5 + [(4, f"start {long[40:300]} end")], [(1, long)] * 2 + [(2, f"{own}|{own}")] * 2):
        docs = table(spark, [(*r, None, None) for r in rows])
        want = byte_dedup(set(rows))
        got = [(r.doc_id, (r.n_bytes, r.n_removed, r.n_spans, r.kept_sha256)) for r in suffix_dedup.digests(docs).collect()]
        assert sorted(got) == sorted((i, want[i]) for i, _ in rows) and want[1][1] == 0
        assert [r.text for r in suffix_dedup.dedup(docs).where("doc_id = 1").collect()] == [long] * rows.count((1, long))


def test_texts_keep_whole_characters(spark):
    docs = table(spark, [(1, "é" * 80, None, None), (2, "aé" + "é" * 60 + "b", None, None), (3, None, None, None)])
    got = {r.doc_id: r.text for r in suffix_dedup.dedup(docs).collect()}
    assert got[2].startswith("a") and got[2].endswith("b") and got[3] == "" and set(got[1]) <= {"é"}


@settings(max_examples=80, deadline=None)
@given(st.text("ab", min_size=1, max_size=400), st.sampled_from([(16, 8), (24, 8), (40, 24)]))
def test_suffixes_are_sorted(text, shape):
    """Quicksort and tries give the order of the windows, and tell which are equal."""
    window, shallow = shape
    data = np.frombuffer(text.encode() + b"\0" * (window + 8), np.uint8)
    at = np.random.default_rng(len(text)).permutation(max(0, len(text) - window + 1))
    order, same = suffix_dedup.suffix_order(data, at, window, shallow)
    got = [text[p : p + window] for p in at[order].tolist()]
    assert got == sorted(got) and sorted(order.tolist()) == list(range(len(at)))
    assert same.tolist() == [k > 0 and got[k] == got[k - 1] for k in range(len(got))]


@settings(max_examples=60, deadline=None)
@given(st.lists(st.text("abc", max_size=120), min_size=1, max_size=6))
def test_segments_hold_every_window_once(texts):
    data = "".join(texts).encode()
    at = np.concatenate([[0], np.cumsum([len(t) for t in texts])])
    grams = Rolling(BYTE[np.frombuffer(data, np.uint8)]).grams(6)
    _, start, count = segments(grams, len(data), at, 6, 20)
    got = sorted(p for a, c in zip(start.tolist(), count.tolist()) for p in range(a, a + c))
    assert got == [p for a, b in zip(at[:-1], at[1:]) for p in range(a, b - 19)]
    digest = digests_of(np.frombuffer(data, np.uint8), start, start + count + 19)
    by = {}
    for h, a, c in zip(map(tuple, digest.tolist()), start.tolist(), count.tolist()):
        assert by.setdefault(h, data[a : a + c + 19]) == data[a : a + c + 19]
    assert len(set(by.values())) == len(by)


@settings(max_examples=80, deadline=None)
@given(st.lists(st.lists(st.sampled_from("abc"), min_size=8, max_size=40), min_size=2, max_size=6))
def test_extension_is_as_far_as_words_agree(rows):
    """Classes of seeds, t words on, are those of equal words."""
    codes = np.array([ord(x) for r in rows for x in r], np.uint64)
    first = np.concatenate([[0], np.cumsum([len(r) for r in rows])])
    seeds = np.concatenate([np.arange(a, b) for a, b in zip(first[:-1], first[1:])])
    own = np.searchsorted(first, seeds, "right") - 1
    for step, room in ((1, first[own + 1] - seeds), (-1, seeds - first[own])):
        got = substring_dedup._extended(codes, seeds, step, room, 12)
        for t in range(1, 13):
            of = {}
            for k, s in enumerate(seeds.tolist()):
                if room[k] >= t:
                    of.setdefault(tuple(codes[s : s + t] if step > 0 else codes[s - t : s]), []).append(k)
            for same in of.values():
                assert {int(got[t, k]) for k in same} == {-1} if len(same) == 1 else len({int(got[t, k]) for k in same}) == 1 and got[t, same[0]] >= 0
            assert len({int(x) for x in got[t] if x >= 0}) == sum(len(s) > 1 for s in of.values())


def test_colliding_hashes_change_nothing(spark, monkeypatch):
    """Units with two codes, so that unlike windows have one minimizer and one hash, hot ones included: contents decide, not hashes."""
    few = lambda units: BYTE[(units & units.dtype.type(1)).astype(np.int64)]
    monkeypatch.setattr(suffix_dedup, "_codes", few)
    monkeypatch.setattr(substring_dedup, "_codes", few)
    docs, rows = documents(spark, 5, 40)
    monkeypatch.setattr(repeats, "SAMPLE", 1)
    for most in (10**9, 3):
        monkeypatch.setattr(repeats, "HOT", most)
        got = {r.doc_id: (r.n_bytes, r.n_removed, r.n_spans, r.kept_sha256) for r in suffix_dedup.digests(docs).collect()}
        assert got == byte_dedup(rows)
    got = {r.doc_id: (r.n_words, r.n_removed, r.kept_sha256) for r in substring_dedup.dedup(docs).collect()}
    assert got == word_dedup(rows)


def test_null_ids_are_dealt_by_text(spark):
    docs = table(spark, [(None, f"text number {k}", None, None) for k in range(400)])
    assert repeats.dealt(docs, 16).select("pid").distinct().count() > 30
    assert suffix_dedup.digests(docs).count() == substring_dedup.dedup(docs).count() == 400


def test_groups_over_batches_are_whole():
    """Pairs are the same wherever batches end."""
    import pyarrow as pa

    r = np.random.default_rng(3)
    base = near_dedup.mix(np.arange(400).astype(np.uint64))
    rows = sorted((int(g), 0, int(p), k) for k, (g, p) in enumerate(zip(r.integers(0, 6, 90), r.integers(0, 2, 90))))
    marks = [near_dedup.parities(np.unique(base[r.integers(0, 12) : 380])).tobytes() for _ in rows]
    columns = {"shingle": [x[0] for x in rows], "i": [x[1] for x in rows], "j": [x[2] for x in rows], "rid": [x[3] for x in rows], "th": [0] * 90, "label": [k % 4 for k in range(90)], "n": [374] * 90}
    batch = pa.RecordBatch.from_pydict(columns | {"marks": pa.array(marks, pa.binary())})
    out = []
    for size in (1, 7, 30, 90):
        parts = near_dedup._meetings(80, False)(iter([batch.slice(a, size) for a in range(0, 90, size)]))
        out.append({tuple(x.values()) for p in parts for x in p.to_pylist()})
    assert out[0] == out[1] == out[2] == out[3] and len(out[0]) > 100


def test_long_texts_in_pieces(spark, monkeypatch):
    """Texts above a piece give the same results as whole ones."""
    from tessera.llm import arrays

    monkeypatch.setattr(repeats, "PIECE", 300)
    for name in ("blocks", "spans_of"):
        monkeypatch.setattr(repeats, name, lambda at, most=200, *a, old=getattr(arrays, name): old(at, min(most, 300), *a))
    docs, rows = documents(spark, 6, 30)
    found = repeats.Finder(32, 100, True, 4, suffix_dedup._units, suffix_dedup._codes, None)
    flat = np.frombuffer(("abc" * 900).encode() + bytes(range(97, 123)) * 40, np.uint8)
    at = np.array([0, 5, 2000, len(flat)])
    seen = sorted((int(r), p) for row, h, s, t, place, count, _ in found._found(flat, at) for r, a, c in zip(row, place.tolist(), count.tolist()) for p in range(a, a + c))
    assert seen == [(r, p) for r in range(3) for p in range(int(at[r + 1] - at[r]) - 99)]


def test_thue_morse_words_differ():
    """Words of two letters that agree under any polynomial modulo 2**64."""
    bits = np.array([bin(k).count("1") & 1 for k in range(4096)])
    a, b = BYTE[97 + bits], BYTE[98 - bits]
    assert (Rolling(a).grams(2048)[:1] != Rolling(b).grams(2048)[:1]).all()


def test_ids_with_several_texts(spark):
    """One text of each group stays, and texts found nowhere else always do, whatever shares their id."""
    a, b, c = (" ".join(f"{x}{k}" for k in range(40)) for x in "abc")
    rows = [(3, a), (5, b), (5, a), (9, c), (None, c), (None, "x y z"), (7, None), (7, None), (8, b + " more"), (5, b)]
    docs = table(spark, [(*r, None, None) for r in rows])
    got = [(r.doc_id, r.text) for r in near_dedup.dedup(docs).collect()]
    assert {t for _, t in got if t} == {a, b, c, "x y z"} and len(got) == 7  # (5, b) twice, null texts twice
    out = [(r.doc_id, r.component_id, r.kept) for r in near_dedup.near_duplicates(docs).collect()]
    assert sorted(x for x in out if x[0] == 5) == [(5, 3, False), (5, 5, True), (5, 5, True)]


def test_rarest_shingles_find_every_link(spark, tmp_path):
    """Of documents that all share a bucket, each link between labels is found, as by comparing all pairs."""
    r = np.random.default_rng(8)
    base = [f"w{k}" for k in range(60)]
    texts = [" ".join(base[:40] + [f"v{i}{k}" for k in range(r.integers(0, 12))] + base[40 + r.integers(0, 3) :]) for i in range(60)]
    docs = table(spark, [(i, t, None, None) for i, t in enumerate(texts)])
    from tessera.llm.common import texts as keyed
    from pyspark.sql import functions as F

    rest = keyed(docs).select("rid", "th", F.struct("rid", "th").alias("label"))
    got = {x.node.rid: x.label.rid for x in near_dedup._rest(docs, rest, 80, 4, 4, f"file://{tmp_path}/r").collect()}
    sets = [{tuple(w[k : k + 4]) for k in range(len(w) - 3)} for w in map(str.split, texts)]
    want = {(i, j) for j in range(60) for i in range(j) if 100 * len(sets[i] & sets[j]) >= 80 * len(sets[i] | sets[j])}
    least = list(range(60))
    for _ in range(60):
        for i, j in want:
            least[i] = least[j] = min(least[i], least[j])
    assert got == {i: x for i, x in enumerate(least) if x != i} and len(want) > 20


@settings(max_examples=60, deadline=None)
@given(st.lists(st.tuples(st.integers(0, 40), st.integers(0, 3), st.integers(1, 3)), min_size=2, max_size=12), st.booleans())
def test_possible_pairs_hold_all_alike_ones(shapes, long):
    """Parities never tell alike sets apart, whatever their sizes; best keeps one of them for each set and label."""
    step = 60 if long else 1
    sets = [np.unique(near_dedup.mix(np.arange(a * step, (a + 30 + 8 * b) * step).astype(np.uint64))) for a, b, _ in shapes]
    label, n = np.array([c for *_, c in shapes]), np.array([len(s) for s in sets])
    end, marks = np.full(len(n), len(n)), [near_dedup.parities(s).tobytes() for s in sets]
    i, j, _ = near_dedup.possible(n, label, marks, end, 80, False)
    got = list(zip(i.tolist(), j.tolist()))
    want = {(i, j) for j in range(len(sets)) for i in range(j) if label[i] != label[j] and near_dedup._alike(sets[i], sets[j], 80)}
    i, j, left_out = near_dedup.possible(n, label, marks, end, 80, True)
    best = list(zip(i.tolist(), j.tolist()))
    assert {i for i, _ in set(got) - set(best)} == set(left_out.tolist())
    assert want <= set(got) and len(got) == len(set(got)) and set(best) <= set(got)
    assert {(i, int(label[j])) for i, j in got} == {(i, int(label[j])) for i, j in best}


def test_hashes_tell_runs_apart():
    codes = BYTE[np.frombuffer(b"abcabcabd", np.uint8)]
    grams = Rolling(codes).grams(3)
    assert grams[0] == grams[3] and grams[0] != grams[6] and len(grams) == 7


def test_merged_runs():
    a = lambda *x: np.array(x)
    rid, th, first, count = merged(a(1, 1, 2, 1), a(0, 0, 0, 0), a(0, 2, 2, 9), a(3, 4, 1, 1))
    assert list(zip(rid, first, count)) == [(1, 0, 6), (1, 9, 1), (2, 2, 1)]


def test_components_of_a_chain_and_a_star(spark, tmp_path):
    edges = [(i, i + 1) for i in range(1, 20)] + [(100, k) for k in range(101, 130)] + [(7, 7)]
    got = dict(components(spark.createDataFrame(edges, "u long, v long"), f"file://{tmp_path}/c").collect())
    assert got == {i: 1 for i in range(2, 21)} | {k: 100 for k in range(101, 130)}
    assert components(spark.createDataFrame([], "u long, v long"), f"file://{tmp_path}/e").collect() == []


def test_tables_of_keys_have_few_files(spark, tmp_path, monkeypatch):
    """Where a session doesn't join small shuffle partitions, tables of a few keys and labels still are a file each (up to one a partition before)."""
    monkeypatch.setattr(near_dedup, "shared_folder", lambda _: f"file://{tmp_path}/t")
    held = {"spark.sql.shuffle.partitions": "24", "spark.sql.adaptive.coalescePartitions.enabled": "false"}
    was = {c: spark.conf.get(c) for c in held}
    rows = [(i, " ".join(f"w{k}" if k != 3 * i else "v" for k in range(120)), "en", "s") for i in range(12)]
    try:
        for c, x in held.items():
            spark.conf.set(c, x)
        got = {r.doc_id: (r.n_shingles, r.component_id, r.kept) for r in near_dedup.near_duplicates(table(spark, rows)).collect()}
    finally:
        for c, x in was.items():
            spark.conf.set(c, x)
    assert got == near_groups(rows) and {g[1] for g in got.values()} == {0}
    files = {t: len(list((tmp_path / "t" / t).glob("part-*"))) for t in ("firsts", "stars", "first/salts", "first/links", "first/components/0", "first/components/1", "known")}
    assert set(files.values()) == {1}, str(files)


def test_files_by_rows(spark, tmp_path, monkeypatch):
    """A table whose rows are counted has a file for each FILE_ROWS of them, any other one for each partition; no row is lost."""
    monkeypatch.setattr(common, "FILE_ROWS", 10)
    docs = spark.range(0, 95, 1, 24)
    for rows, files in ((95, 10), (0, 1), (None, 24), (10_000, 24)):
        got = common.written(docs, f"file://{tmp_path}/{rows}", rows)
        assert sorted(r.id for r in got.collect()) == list(range(95)) and len(list((tmp_path / str(rows)).glob("part-*"))) == files
