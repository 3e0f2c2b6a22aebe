"""The pipeline's stages against brute force, each on its predecessor's rows."""

import random

import corpus_pipeline
import pyarrow as pa
from corpus import WORD, byte_dedup, near_groups
from tessera.llm import decontaminate, queries
from tessera.llm.common import BATCH_BYTES, BATCH_LIMIT

COLUMNS = ["doc_id", "text", "lang", "source", "n_chars"]
SCHEMA = "doc_id long, text string, lang string, source string, n_chars long"


def corpus(spark, folder):
    r = random.Random(9)
    words = ["".join(r.choice("abcdefgh") for _ in range(r.randint(2, 6))) for _ in range(400)]
    say = lambda n: " ".join(r.choice(words) for _ in range(n))
    items, passage, rows, labels = [say(20) for _ in range(4)], say(40), [], []
    for i in range(240):
        text, bad = say(r.randint(20, 80)), i % 5 == 0
        if bad:
            text = f"{text} vileword {say(3)}"
        elif i % 5 == 1 and rows:
            text = r.choice([x[1] for x in rows if "vileword" not in x[1]] or [text])
        elif i % 5 == 2:
            text = f"{text} {passage} {say(5)}"
        elif i % 23 == 3:
            text = f"{text} {items[i % 4]} {say(4)}"
        rows.append((i, text, "en", f"s{i % 3}", len(text)))
        labels.append((i, 1, int(bad)))
    spark.createDataFrame(rows, SCHEMA).write.parquet(f"{folder}/documents.parquet")
    spark.createDataFrame(labels, "doc_id long, quality int, toxic int").write.parquet(f"{folder}/labels.parquet")
    spark.createDataFrame(list(enumerate(items)), "item_id long, text string").write.parquet(f"{folder}/benchmark.parquet")
    return items


def test_stages_as_brute_force(spark, tmp_path):
    folder = f"file://{tmp_path}/t"
    items = corpus(spark, folder)
    docs, kept = spark.read.parquet(f"{folder}/documents.parquet"), []
    for k, (_, stage) in enumerate(corpus_pipeline.STAGES):
        stage(spark, docs, folder).write.parquet(f"{tmp_path}/{k}")
        docs = spark.read.parquet(f"{tmp_path}/{k}")
        kept.append({r.doc_id: r for r in docs.collect()})
        assert k == 4 or docs.columns == COLUMNS
    clean, single, cut, safe, mixed = kept
    assert set(clean) == {i for i in range(240) if i % 5}
    assert set(single) == {i for i, g in near_groups([(i, x.text) for i, x in clean.items()]).items() if g[2]} and len(single) < len(clean)
    removed = byte_dedup([(i, x.text) for i, x in single.items()])
    assert {i: len(x.text.encode()) for i, x in cut.items()} == {i: n - gone for i, (n, gone, *_) in removed.items()} and sum(x[1] for x in removed.values())
    assert all(x.n_chars == len(x.text) for x in cut.values())
    assert set(safe) == {i for i, x in cut.items() if not any(decontaminate.normal(t) in decontaminate.normal(x.text) for t in items)} and len(safe) < len(cut)
    sizes = {i: len(WORD.findall(x.text)) for i, x in safe.items()}
    assert all(x.size == sizes[i] and 0 < x.taken <= 2 * x.size for i, x in mixed.items()) and set(mixed) <= set(safe)
    assert abs(sum(x.taken for x in mixed.values()) - 1.5 * sum(sizes.values())) <= 3
    again = {r.doc_id: r.taken for r in corpus_pipeline.run(spark, folder).collect()}
    assert again == {i: x.taken for i, x in mixed.items()}


def test_near_duplicates_by_five_words(spark):
    """Texts with 10 of 400 words changed are alike by four words (0.82), not by five (0.78): the stage keeps them, and drops those with fewer changes."""
    base = [f"w{k}" for k in range(400)]
    changed = lambda i, n: [f"v{i}" if k % 39 == 20 and k // 39 < n else w for k, w in enumerate(base)]
    rows = [(i, " ".join(changed(i, n)), "en", "s", 0) for i, n in enumerate([0, 10, 10, 8, 3, 10])]
    docs, group = spark.createDataFrame(rows, SCHEMA), {}
    for k in (4, 5):
        sets = [{tuple(w[a : a + k]) for a in range(len(w) - k + 1)} for w in (x[1].split() for x in rows)]
        group[k] = list(range(len(rows)))
        for i in range(len(rows)):
            for j in range(i):
                if 100 * len(sets[i] & sets[j]) >= 80 * len(sets[i] | sets[j]):
                    a, b = sorted((group[k][i], group[k][j]))
                    group[k] = [a if g == b else g for g in group[k]]
    got = {r.doc_id for r in corpus_pipeline.drop_near_duplicates(spark, docs, "").collect()}
    assert got == set(group[5]) and got > set(group[4])


def test_stages_of_odd_rows(spark, tmp_path):
    """Nulls, empty texts, repeated rows and ids, clashing columns and empty tables pass all stages; clean texts stay, each once."""
    folder = f"file://{tmp_path}/t"
    corpus(spark, folder)
    one, two = (" ".join(f"{x}{k}" for k in range(60)) for x in "pq")
    rows = [(1, one, "en", "s", 0), (1, one, "en", "s", 0), (1, two, None, None, None), (2, one, "en", "s", 0), (None, None, None, None, None), (None, None, None, None, None), (3, "", "en", "s", 0), (4, "word", None, "s", 4)]
    names = ["kept", "rid", "th", "label", "size", "taken", "x0", "removed", "expected_grade", "gone_rid", "key"]
    docs = spark.createDataFrame([(*r, *range(len(names))) for r in rows], f"{SCHEMA}, {', '.join(f'{n} long' for n in names)}")
    columns, kept = docs.columns, []
    for k, (_, stage) in enumerate(corpus_pipeline.STAGES):
        empty = stage(spark, docs.limit(0), folder)
        assert empty.count() == 0 and (k == 4 or empty.columns == columns)
        stage(spark, docs, folder).write.parquet(f"{tmp_path}/odd{k}")
        docs = spark.read.parquet(f"{tmp_path}/odd{k}")
        kept.append(docs.collect())
    assert len(kept[0]) == 8
    assert sorted(str((r.doc_id, r.text)) for r in kept[1]) == sorted(str(x[:2]) for x in rows if x[:2] != (2, one))
    assert {r.text for r in kept[2]} == {one, two, "", "word"} and len(kept[3]) == 7
    assert {r.doc_id for r in kept[4]} == {1, 4}


def test_batches_to_python_are_small(spark, tmp_path):
    """However long texts are, no stage passes a worker more than BATCH_BYTES and a row at once (12 MB before); a limit of the session's own holds."""
    folder, was = f"file://{tmp_path}/t", spark.conf.get(BATCH_LIMIT, None)
    corpus(spark, folder)
    row = 20_000
    docs = spark.range(0, 600, 1, 1).selectExpr("id AS doc_id", f"rpad(concat('word', id, ' '), {row}, 'some more ') AS text", "'en' AS lang", "'s' AS source", f"{row}L AS n_chars")

    def sizes(batches):
        for batch in batches:
            yield pa.RecordBatch.from_pydict({"n": [batch.num_rows], "size": [batch.nbytes]})

    try:
        for stage in (0, 3):
            for own, most in ((None, BATCH_BYTES), (str(1 << 18), 1 << 18)):
                spark.conf.unset(BATCH_LIMIT)
                if own:
                    spark.conf.set(BATCH_LIMIT, own)
                got = corpus_pipeline.STAGES[stage][1](spark, docs, folder).mapInArrow(sizes, "n long, size long").collect()
                assert sum(x.n for x in got) == 600 and max(x.size for x in got) <= 1.1 * most + 2 * row
    finally:
        spark.conf.unset(BATCH_LIMIT)
        if was:
            spark.conf.set(BATCH_LIMIT, was)


def test_batches_change_no_result(spark, tmp_path):
    """All stages, with a batch for each row or two, as with whole partitions in one."""
    folder, was, got = f"file://{tmp_path}/t", spark.conf.get(BATCH_LIMIT, None), []
    corpus(spark, folder)
    try:
        for most in ("300", str(1 << 26)):
            spark.conf.set(BATCH_LIMIT, most)
            got.append(sorted((r.doc_id, r.size, r.target, r.taken) for r in corpus_pipeline.run(spark, folder).collect()))
    finally:
        spark.conf.unset(BATCH_LIMIT)
        if was:
            spark.conf.set(BATCH_LIMIT, was)
    assert got[0] == got[1] and got[0]


def test_every_query_is_registered():
    numbers = sorted(int(n[2:].split("_")[0]) for n in queries.QUERIES)
    assert numbers == list(range(1, 11)) and set(queries.ORACLES) <= set(queries.QUERIES)
