"""MinHash near-dedup: one-permutation hashing with optimal densification, bands, and star-shaped candidate edges.

Nodes of the graph are (rid, th), a document's id and the hash of its text, so texts that share an id aren't mistaken for each other.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .arrays import LOWER, SPACED, Rolling, U, blocks, mix, utf8, word_codes, words
from .common import NO_ID, id_of, little, pieces, shared_folder, texts, written
from .components import components

SHINGLE = 4
BANDS, ROWS = 64, 7
BINS = BANDS * ROWS


def shingles(flat: np.ndarray, at: np.ndarray, k: int = SHINGLE) -> tuple[np.ndarray, np.ndarray]:
    """The distinct shingles of each text as sorted hashes, and where each text's begin. Texts under k words have one, of all words."""
    flat = LOWER[flat]
    start, end, first = words(flat, at, SPACED)
    n = np.diff(first)
    codes = word_codes(flat, start, end)
    rolling = Rolling(codes)
    grams = rolling.grams(k)
    text = np.repeat(np.arange(len(n)), n)
    whole = np.arange(len(codes)) + k <= first[1:][text]
    short = np.flatnonzero((n > 0) & (n < k))
    own = np.concatenate([text[whole], short])
    got = np.concatenate([grams[whole[: len(grams)]], rolling.runs(first[short], first[short + 1]) + n[short].astype(U)])
    order = np.lexsort((got, own))
    own, got = own[order], got[order]
    new = np.ones(len(own), bool)
    new[1:] = (own[1:] != own[:-1]) | (got[1:] != got[:-1])
    return got[new], np.searchsorted(own[new], np.arange(len(n) + 1))


def signatures(sets: np.ndarray, at: np.ndarray, bins: int = BINS) -> np.ndarray:
    """One permutation: each set's least hash in each bin; an empty bin copies the first that isn't in its own random order of bins."""
    n = len(at) - 1
    empty = U(2**64 - 1)
    low = np.full((n, bins), empty, U)
    h = mix(sets)
    np.minimum.at(low.ravel(), np.repeat(np.arange(n), np.diff(at)) * bins + ((h >> U(32)) * U(bins) >> U(32)).astype(np.int64), h)
    filled = low != empty
    used = filled.sum(1)
    one = used == 1
    low[one] = low[one].min(1, keepdims=True)
    row, col = np.nonzero(~filled & (used > 1)[:, None])
    attempt = 0
    out = low.copy()
    while len(row):
        attempt += 1
        to = (mix(col.astype(U) * U(0x2545F4914F6CDD1D) + U(attempt)) >> U(32)) * U(bins) >> U(32)
        to = to.astype(np.int64)
        ok = filled[row, to]
        out[row[ok], col[ok]] = low[row[ok], to[ok]]
        row, col = row[~ok], col[~ok]
    return out


def buckets(signature: np.ndarray, bands: int = BANDS) -> np.ndarray:
    """The key of each band of each signature."""
    x = signature.reshape(len(signature), bands, -1)
    key = np.zeros(x.shape[:2], U)
    for i in range(x.shape[2]):
        key = mix(key + x[:, :, i])
    return mix(key + np.arange(1, bands + 1, dtype=U)[None, :])


def _sketch(k: int):
    """Texts to the sizes, keys and bands of their sets of shingles of k words."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            flat, at = utf8(batch.column("text"))
            for i, j in blocks(at, 1 << 19):
                for a in range(i, j, 2_000):
                    b = min(a + 2_000, j)
                    sets, first = shingles(flat[at[a] : at[b]], at[a : b + 1] - at[a], k)
                    n = np.diff(first)
                    some = n > 0
                    keys = np.zeros((2, b - a), np.int64)
                    if some.any():
                        for key, h in enumerate((mix(sets), mix(sets + U(0x51ED270B0A1F39C5)))):
                            keys[key, some] = np.add.reduceat(h, first[:-1][some]).view(np.int64)
                    bands = buckets(signatures(sets, first))[some].view(np.int64)
                    lists = pa.ListArray.from_arrays(pa.array(np.concatenate([[0], np.cumsum(some) * BANDS]).astype(np.int32)), pa.array(bands.ravel()))
                    columns = [batch.column("rid").slice(a, b - a), batch.column("th").slice(a, b - a), pa.array(n.astype(np.int64)), pa.array(keys[0]), pa.array(keys[1]), lists]
                    yield pa.RecordBatch.from_arrays(columns, ["rid", "th", "n", "k1", "k2", "bands"])

    return run


def _alike(a: np.ndarray, b: np.ndarray, percent: int) -> bool:
    """100 * size of the intersection >= percent * size of the union, on whole sets."""
    small, large = sorted((len(a), len(b)))
    if 100 * small < percent * large:
        return False
    both = len(np.intersect1d(a, b, assume_unique=True))
    return 100 * both >= percent * (len(a) + len(b) - both)


LINK = "u struct<rid: long, th: long>, v struct<rid: long, th: long>"
_NODE = pa.struct([("rid", pa.int64()), ("th", pa.int64())])


def _verify_stars(percent: int, k: int):
    """Rows of (center, salt), the center's own first: which members are linked with it. Sets are made of some texts at a time."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        key, center = None, None
        for batch in batches:
            rows = [batch.column(c).to_pylist() for c in ("c_rid", "c_th", "salt", "member", "rid", "th")]
            found: list[tuple] = []
            flat, at = utf8(batch.column("text"))
            for i, j in blocks(at, 1 << 19):
                sets, first = shingles(flat[at[i] : at[j]], at[i : j + 1] - at[i], k)
                for n, (c_rid, c_th, salt, member, rid, th) in enumerate(zip(*(r[i:j] for r in rows))):
                    own = sets[first[n] : first[n + 1]]
                    if not member:
                        key, center = (c_rid, c_th, salt), own.copy()
                    elif key == (c_rid, c_th, salt) and _alike(center, own, percent):
                        found.append(({"rid": rid, "th": th}, {"rid": c_rid, "th": c_th}))
            u, v = zip(*found) if found else ([], [])
            yield pa.RecordBatch.from_arrays([pa.array(u, _NODE), pa.array(v, _NODE)], ["u", "v"])

    return run


#: Counters of shingles over the documents of open buckets. Shingles may share one: it orders them, and any order is right.
COUNTERS = 1 << 18


def _slots(sets: np.ndarray) -> np.ndarray:
    return ((mix(sets) >> U(32)) * U(COUNTERS) >> U(32)).astype(np.int64)


def _tally(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    counts = np.zeros(COUNTERS, np.int64)
    for batch in batches:
        counts += np.bincount(_slots(batch.column("shingles").flatten().to_numpy().view(U)), minlength=COUNTERS)
    used = np.flatnonzero(counts)
    yield pa.RecordBatch.from_arrays([pa.array(used), pa.array(counts[used])], ["slot", "n"])


def _set_rows(k: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            flat, at = utf8(batch.column("text"))
            for i, j in blocks(at, 1 << 19):
                sets, first = shingles(flat[at[i] : at[j]], at[i : j + 1] - at[i], k)
                own = batch.slice(i, j - i)
                yield pa.RecordBatch.from_arrays([own.column("rid"), own.column("th"), pa.ListArray.from_arrays(pa.array(first.astype(np.int32)), pa.array(sets.view(np.int64)))], ["rid", "th", "shingles"])

    return run


def _prefixes(percent: int, sent):
    """The rarest shingles of each set, as many as two sets need to share one if they are alike: n - ceil(percent * n / 100) + 1."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        counts = sent.value
        for batch in batches:
            lists = batch.column("shingles")
            sets, n = lists.flatten().to_numpy().view(U), lists.value_lengths().to_numpy().astype(np.int64)
            own = np.repeat(np.arange(len(n)), n)
            order = np.lexsort((sets, counts[_slots(sets)], own))
            nth = np.arange(len(own)) - np.repeat(np.cumsum(n) - n, n)
            some = nth < (n - (percent * n + 99) // 100 + 1)[own]
            row = pa.array(own[some])
            yield pa.RecordBatch.from_arrays([*(batch.column(c).take(row) for c in ("rid", "th")), pa.array(sets[order[some]].view(np.int64))], ["rid", "th", "shingle"])

    return run


def parities(own: np.ndarray) -> np.ndarray:
    """Of a set: for each of 1,024 bits, or as many as it has members if that is more (up to 65,536), whether an odd number of them falls there.

    The bits in which two sets differ are no more than the members in which they do, so this tells unlike sets and never alike ones.
    Halves xored together are the bits for half as many.
    """
    size = 1 << min(16, max(10, int(len(own) - 1).bit_length()))
    return np.packbits((np.bincount((mix(own + U(0x2545F4914F6CDD1D)) & U(size - 1)).astype(np.int64), minlength=size) & 1).astype(bool)).view(U)


def _marks(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        lists = batch.column("shingles")
        marks = [parities(x.values.to_numpy().view(U)).tobytes() for x in lists]
        yield pa.RecordBatch.from_arrays([batch.column("rid"), batch.column("th"), lists.value_lengths().cast(pa.int64()), pa.array(marks, pa.binary())], ["rid", "th", "n", "marks"])


#: Pairs looked at together.
PAIRS = 1 << 19


def possible(n: np.ndarray, label: np.ndarray, marks: list[bytes], end: np.ndarray, percent: int, best: bool) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Pairs i < j of sets of one group (rows up to end[i]) with different labels that can be alike by their sizes and parities.

    best: of a set and one label only the likeliest. The third array tells of rows i from which pairs were left out so.
    """
    width = np.array([len(m) // 8 for m in marks])
    read = {v: np.frombuffer(b"".join([marks[i] for i in np.flatnonzero(width == v).tolist()]), U).reshape(-1, v) for v in np.unique(width).tolist()}
    table = {}
    for w in read:  # the sets with w words of bits or more, folded to w
        place, parts = np.zeros(len(n), np.int64), []
        for v, bits in read.items():
            if v >= w:
                place[width == v] = np.arange(len(bits)) + sum(map(len, parts))
                while bits.shape[1] > w:
                    bits = bits[:, : bits.shape[1] // 2] ^ bits[:, bits.shape[1] // 2 :]
                parts.append(bits)
        table[w] = place, np.concatenate(parts)
    found, left_out = [], []
    partners = end - np.arange(len(n)) - 1
    first = 0
    total = np.concatenate([[0], np.cumsum(partners)])
    while first < len(n):
        last = max(first + 1, int(np.searchsorted(total, total[first] + PAIRS, "right")) - 1)
        i = np.repeat(np.arange(first, last), partners[first:last])
        j = np.arange(len(i)) - (total[i] - total[first]) + i + 1
        first = last
        ok = label[i] != label[j]
        i, j = i[ok], j[ok]
        ok = 100 * np.minimum(n[i], n[j]) >= percent * np.maximum(n[i], n[j])
        i, j = i[ok], j[ok]
        both, apart = np.minimum(width[i], width[j]), np.zeros(len(i), np.int64)
        for w in np.unique(both).tolist():
            some = np.flatnonzero(both == w)
            place, bits = table[w]
            apart[some] = np.bitwise_count(bits[place[i[some]]] ^ bits[place[j[some]]]).sum(1, dtype=np.int64)
        # |A xor B| of alike sets is at most (|A| + |B|) * (100 - percent) / (100 + percent)
        ok = apart * (100 + percent) <= (n[i] + n[j]) * (100 - percent)
        i, j, apart = i[ok], j[ok], apart[ok]
        if best and len(i):
            order = np.lexsort((apart, label[j], i))
            i, j = i[order], j[order]
            top = np.concatenate([[True], (i[1:] != i[:-1]) | (label[j[1:]] != label[j[:-1]])])
            left_out.append(i[~top])
            i, j = i[top], j[top]
        found.append((i, j))
    i, j = (np.concatenate([f[k] for f in found]) if found else np.zeros(0, np.int64) for k in (0, 1))
    return i, j, np.concatenate(left_out) if left_out else np.zeros(0, np.int64)


def _meetings(percent: int, best: bool):
    """Rows sorted by (shingle, i, j), each such group whole: pairs that can be alike, the center being the lesser, and shingles of which pairs were left out."""

    def found(held: list[pa.RecordBatch]) -> pa.RecordBatch:
        rows = pa.Table.from_batches(held).combine_chunks()
        shingle, i, j, rid, th, label, n = (rows.column(c).to_numpy() for c in ("shingle", "i", "j", "rid", "th", "label", "n"))
        new = np.concatenate([(shingle[1:] != shingle[:-1]) | (i[1:] != i[:-1]) | (j[1:] != j[:-1]), [True]])
        edge = np.flatnonzero(new) + 1
        a, b, more = possible(n, label, rows.column("marks").to_pylist(), edge[np.searchsorted(edge, np.arange(len(n)), "right")], percent, best)
        swap = (rid[a] < rid[b]) | ((rid[a] == rid[b]) & (th[a] < th[b]))
        member, center = np.where(swap, b, a), np.where(swap, a, b)
        more = np.unique(shingle[more])
        pad = lambda x: pa.concat_arrays([pa.array(x), pa.nulls(len(more), pa.int64())])
        return pa.RecordBatch.from_arrays([pad(rid[member]), pad(th[member]), pad(rid[center]), pad(th[center]), pa.concat_arrays([pa.nulls(len(a), pa.int64()), pa.array(more)])], ["rid", "th", "c_rid", "c_th", "shingle"])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: list[pa.RecordBatch] = []
        for batch in batches:
            if not batch.num_rows:
                continue
            key = [batch.column(c).to_numpy() for c in ("shingle", "i", "j")]
            last = np.flatnonzero(np.any([k != k[-1] for k in key], axis=0))
            cut = int(last[-1]) + 1 if len(last) else 0  # the last group may go on
            if held and (cut or any(held[-1].column(c)[-1].as_py() != k[0] for c, k in zip(("shingle", "i", "j"), key))):
                whole = cut if not any(held[-1].column(c)[-1].as_py() != k[0] for c, k in zip(("shingle", "i", "j"), key)) else 0
                yield found([*held, batch.slice(0, whole)])
                held, batch, cut = [], batch.slice(whole), cut - whole
            if cut:
                yield found([batch.slice(0, cut)])
            held.append(batch.slice(cut))
        if held:
            yield found(held)

    return run


#: Members of a star that one task compares with its center; documents of a part of those that meet at one shingle.
STAR_ROWS, GROUP_ROWS = 2_000, 2_000


def _verified(docs: DataFrame, stars: DataFrame, percent: int, k: int, n: int, path: str) -> DataFrame:
    """(u, v) of the rows (rid, th, c_rid, c_th) of stars whose member and center are alike, by whole sets. Stars with many members are salted."""
    most = stars.count()
    salts = stars.groupBy("c_rid", "c_th").agg(F.ceil(F.count("*") / STAR_ROWS).cast("int").alias("salts"))
    salts = written(salts, f"{path}/salts", most)
    spokes = stars.join(salts, ["c_rid", "c_th"]).select("rid", "th", "c_rid", "c_th", F.pmod(F.hash("rid", "th"), "salts").alias("salt"), F.lit(True).alias("member"))
    hubs = salts.select(F.col("c_rid").alias("rid"), F.col("c_th").alias("th"), "c_rid", "c_th", F.explode(F.sequence(F.lit(0), F.col("salts") - 1)).alias("salt"), F.lit(False).alias("member"))
    wanted = written(spokes.unionByName(hubs), f"{path}/wanted", 2 * most)
    routed = texts(docs).join(little(wanted), ["rid", "th"]).repartition(n, "c_rid", "c_th", "salt").sortWithinPartitions("c_rid", "c_th", "salt", "member")
    return written(routed.mapInArrow(_verify_stars(percent, k), LINK).distinct(), f"{path}/links", most)


def _rest(docs: DataFrame, rest: DataFrame, percent: int, k: int, n: int, folder: str) -> DataFrame:
    """(node, label): the labels of rest (rid, th, label) after all links between them, for nodes whose label changes.

    Alike sets share a shingle among their rarest ones, so documents meet at these; boilerplate that many share is rare in none. Of those that meet
    at one, the documents of its most frequent label needn't be compared with each other: they are dealt in parts, and the others go to each.
    First only the likeliest pair of a document and a label is verified, which joins what can be joined; then, where pairs were left out, all of labels that still differ.
    """
    spark = docs.sparkSession
    sets = texts(docs).join(little(rest.select("rid", "th")), ["rid", "th"]).dropDuplicates(["rid", "th"]).mapInArrow(_set_rows(k), "rid long, th long, shingles array<long>")
    sets = written(sets, f"{folder}/sets")
    tally = sets.select("shingles").mapInArrow(_tally, "slot long, n long").groupBy("slot").agg(F.sum("n").alias("n")).toArrow()
    counts = np.zeros(COUNTERS, np.int64)
    counts[tally.column("slot").to_numpy()] = tally.column("n").to_numpy()
    rare = sets.mapInArrow(_prefixes(percent, spark.sparkContext.broadcast(counts)), "rid long, th long, shingle long")
    rare = written(rare, f"{folder}/rare")
    twice = rare.groupBy("shingle").count().where("count > 1").select("shingle")
    rare = written(rare.join(written(twice, f"{folder}/twice", rare.count()), "shingle"), f"{folder}/meeting")
    more, many = None, rest.count()
    marks = written(sets.mapInArrow(_marks, "rid long, th long, n long, marks binary"), f"{folder}/marks")
    now, node = rest.select(F.struct("rid", "th").alias("node"), "label"), F.struct("rid", "th")
    for step, best in ((1, True), (2, False)):
        labels = now.select("node.*", F.struct("label.rid", "label.th").alias("label"))
        named = rare if more is None else rare.join(little(more), "shingle", "left_semi")
        named = written(named.join(little(labels), ["rid", "th"]), f"{folder}/{step}/named")
        per = named.groupBy("shingle", "label").count().groupBy("shingle").agg(F.max(F.struct("count", "label")).alias("top"), F.sum("count").alias("all"), F.count("*").alias("labels"))
        per = written(per.where("labels > 1").select("shingle", F.col("top.label").alias("most"), F.ceil(F.col("top.count") / GROUP_ROWS).cast("int").alias("p"), F.ceil((F.col("all") - F.col("top.count")) / GROUP_ROWS).cast("int").alias("q")), f"{folder}/{step}/groups", named.count())
        dealt = named.join(per, "shingle").withColumn("major", F.col("label") == F.col("most"))
        h = F.xxhash64("rid", "th")
        dealt = dealt.withColumn("part", F.when(F.col("major"), F.pmod(h, "p")).otherwise(F.col("p") + F.pmod(h, "q")).cast("int"))
        dealt = dealt.withColumn("other", F.explode(F.sequence(F.lit(0), F.col("p") + F.col("q") - 1))).where("IF(major, other >= p, other < p OR other <> part)")
        dealt = dealt.select("shingle", F.least("part", "other").alias("i"), F.greatest("part", "other").alias("j"), "rid", "th", F.xxhash64("label").alias("label")).join(marks, ["rid", "th"])
        pairs = dealt.repartition(n, "shingle", "i", "j").sortWithinPartitions("shingle", "i", "j").mapInArrow(_meetings(percent, best), "rid long, th long, c_rid long, c_th long, shingle long").distinct()
        pairs = written(pairs, f"{folder}/{step}/pairs")
        more = pairs.where("shingle IS NOT NULL").select("shingle").distinct()
        found = _verified(docs, pairs.where("shingle IS NULL").drop("shingle"), percent, k, n, f"{folder}/{step}")
        links = found.count()
        found = found.join(now.select(F.col("node").alias("u"), F.col("label").alias("lu")), "u").join(now.select(F.col("node").alias("v"), F.col("label").alias("lv")), "v")
        last = components(found.select(F.col("lu").alias("u"), F.col("lv").alias("v")), f"{folder}/{step}/components", links)
        moved = now.join(little(last.select(F.col("node").alias("label"), F.col("label").alias("to"))), "label", "left").select("node", F.coalesce("to", "label").alias("label"))
        now = written(moved, f"{folder}/{step}/labels", many)
    was = rest.select(node.alias("node"), F.col("label").alias("old"))
    return now.join(was, "node").where("label <> old").select(F.col("old").alias("node"), "label").distinct()


def _grouped(docs: DataFrame, percent: int, k: int) -> tuple[DataFrame, int]:
    """(rid, th, n, label) and how many rows: one row for each row; label is the least (rid, th) reachable, the row's own where it is linked with nothing.

    Equal sets are collapsed first. Of each bucket of a band the least document is the center of a star, and each other member a
    candidate with it alone. Where a bucket's members aren't all connected by the links so confirmed, its documents are searched for links
    between components by their rarest shingles; so stars lose no link.
    """
    spark = docs.sparkSession
    folder = shared_folder(spark)
    n = pieces(docs)
    rows = written(texts(docs).mapInArrow(_sketch(k), "rid long, th long, n long, k1 long, k2 long, bands array<long>"), f"{folder}/rows")
    node, many = F.struct("rid", "th"), rows.count()
    firsts = written(rows.where("n > 0").groupBy("k1", "k2", "n").agg(F.min(node).alias("first"), F.count("*").alias("copies")), f"{folder}/firsts", many)
    reps = rows.where("n > 0").join(little(firsts.select("first.*")), ["rid", "th"], "left_semi").dropDuplicates(["rid", "th"])
    banded = written(reps.select("rid", "th", F.explode("bands").alias("bucket")), f"{folder}/banded", BANDS * many)
    keys = banded.count()
    shared = banded.groupBy("bucket").agg(F.min(node).alias("c"), F.count("*").alias("members")).where("members > 1")
    shared = written(shared.select("bucket", F.col("c.rid").alias("c_rid"), F.col("c.th").alias("c_th")), f"{folder}/shared", keys // 2)
    members = written(banded.join(little(shared), "bucket"), f"{folder}/members", keys)

    most = members.count()
    stars = written(members.where("rid <> c_rid OR th <> c_th").select("rid", "th", "c_rid", "c_th").distinct(), f"{folder}/stars", most)
    links = _verified(docs, stars, percent, k, n, f"{folder}/first")
    label = components(links, f"{folder}/first/components", links.count())

    named = members.select("bucket", node.alias("node")).join(little(label), "node", "left").select("bucket", "node", F.coalesce("label", "node").alias("label"))
    named = written(named, f"{folder}/named", most)
    open_ = named.groupBy("bucket").agg(F.min("label").alias("low"), F.max("label").alias("high")).where("low < high").select("bucket")
    rest = written(named.join(written(open_, f"{folder}/open", most // 2), "bucket").select("node.*", "label").distinct(), f"{folder}/rest", most)
    if not rest.isEmpty():
        last = written(_rest(docs, rest, percent, k, n, f"{folder}/rest-of"), f"{folder}/last", many)  # from labels to labels
        moved = label.join(little(last.select(F.col("node").alias("label"), F.col("label").alias("to"))), "label", "left").select("node", F.coalesce("to", "label").alias("label"))
        label = written(moved.unionByName(last.join(label.select("node"), "node", "left_anti")), f"{folder}/labels", many)

    known = firsts.join(label.withColumnRenamed("node", "first"), "first", "left").where("copies > 1 OR label IS NOT NULL").select("k1", "k2", "n", F.coalesce("label", "first").alias("known"))
    known = written(known, f"{folder}/known", many)
    out = rows.select("rid", "th", "n", "k1", "k2").join(little(known), ["k1", "k2", "n"], "left")
    return out.select("rid", "th", "n", F.coalesce(F.when(F.col("n") > 0, F.col("known")), node).alias("label")), many


def near_duplicates(docs: DataFrame, percent: int = 80, k: int = SHINGLE) -> DataFrame:
    """doc_id, n_shingles, component_id, kept: one row for each row.

    Documents are linked if 100 * intersection >= percent * union of their sets of shingles of k words; component_id is the least id
    reachable, kept says that it is the document's own. Null texts and texts without words have empty sets and are linked with nothing.
    A null id is the smallest. Rows of one id but different texts are nodes of their own; where they are linked with each other, all are kept here, but
    dedup() keeps the first text alone. Links are confirmed on whole sets; a link at the threshold is missed as a candidate with a probability of 3e-7, and
    only if no other link of its documents puts both into buckets with others.
    """
    out, _ = _grouped(docs, percent, k)
    return out.select(id_of(F.col("rid")), F.col("n").alias("n_shingles"), id_of(F.col("label.rid")).alias("component_id"), (F.col("rid") == F.col("label.rid")).alias("kept"))


def dedup(docs: DataFrame, percent: int = 80, k: int = SHINGLE) -> DataFrame:
    """docs without the rows whose id and text near_duplicates() doesn't keep, in docs' columns: of each group one text stays.

    Rows equal in id and text are one document and stay or go together; rows of one id with unlike texts are told apart.
    """
    rows, many = _grouped(docs, percent, k)
    gone = rows.where("struct(rid, th) <> label").select(F.col("rid").alias("gone_rid"), F.col("th").alias("gone_th")).distinct()
    gone = written(gone, f"{shared_folder(docs.sparkSession)}/gone", many)
    rid, th = F.coalesce(docs["doc_id"].cast("long"), F.lit(NO_ID)), F.xxhash64(F.coalesce(docs["text"].cast("string"), F.lit("")))
    return docs.join(little(gone), (rid == gone["gone_rid"]) & (th == gone["gone_th"]), "left_anti")
