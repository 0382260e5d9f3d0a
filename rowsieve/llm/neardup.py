"""Near duplicates by HyperMinHash: compressed registers, banding, estimation, exact verification.

1. A text's distinct word shingles are hashed. Texts with the same set (its digest tells) are one class
   with a number, and go on as one.
2. Of each of ``FUNCTIONS`` hash functions the shingles are dealt to ``BUCKETS`` buckets, and of a
   bucket's smallest hash the register keeps the number of leading zeros and some mantissa bits:
   one byte. ``ROWS`` registers are a band; classes that agree on a band are in one bucket of it.
   At a similarity of 0.75, ``BANDS`` bands miss a pair with a probability below 4e-6. Small sets
   would leave buckets empty; for them as many functions as registers see the whole set. Sets whose
   size is near the border have both kinds.
3. A set's parity is kept as well: bits that tell how far two sets are apart at least.
   Pairs come from buckets as stars: a few pivots against the others, and only between classes that
   are not yet connected. Each round has more pivots, until no bucket holds an untested pair of
   classes that are not connected; so no link between components is lost, and a group of many near
   copies costs about its size, not its square. After the first round a pair is made only if the
   parities of its sets allow the similarity asked for; that bound is exact.
4. A pair's similarity is estimated by equal registers, corrected for those that agree by chance, as
   the sizes of both sets and the buckets they fill make it likely; pairs that are far below the threshold (over six standard deviations) are dropped. The others
   are confirmed on the full sets.
5. Links become components, whose smallest document id names them.

Tables between the steps are written to the shared folder. A frequent bucket counts one row for
each task that sees it until its members are paired, so it does not pile up in one place.

Defined results: a null text, or one without words, has an empty set and is linked with nothing; a
null id is linked with nothing, its component is null and it is kept; rows with the same id are one
document in components, and each has its row; texts are handled whole, and a very long one is a large
set in one task; without documents there are no rows; other columns are not read.
"""

from __future__ import annotations

import hashlib
from functools import reduce
from operator import add

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from rowsieve.llm.components import components
from rowsieve.llm.frames import column, table, texts
from rowsieve.llm.memory import tidy
from rowsieve.llm.words import Words, chunks, mixed

SHINGLE = 5
#: The threshold as a fraction of whole numbers.
SIMILAR = (75, 100)
FUNCTIONS, BUCKETS, ROWS = 24, 16, 6
REGISTERS = FUNCTIONS * BUCKETS
BANDS = REGISTERS // ROWS
#: Bits of a set's parity, by which pairs are told apart within the join that makes them.
PARITY_BITS = 1024
#: Sets up to this size have registers of the whole set.
SMALL = 64
CHUNK_BYTES = 1 << 20
#: Pairs whose sizes are looked at together, of which each takes about 25 kB.
SIZES_AT_ONCE = 500
#: Keys that a task brings together before it sends them on.
GATHER_KEYS = 1 << 20
#: Pivots of a bucket in the first round; each round has so many times more.
GROWTH = 64

_SEEDS = mixed(np.arange(1001, 1001 + REGISTERS, dtype=np.uint64))
_ODD = mixed(np.arange(1, FUNCTIONS + 1, dtype=np.uint64)) | np.uint64(1)
_SKETCH = "doc_id bigint, n int, digest binary, registers binary, parity array<bigint>"


def shingles(texts: pa.Array, size: int = SHINGLE) -> tuple[list[np.ndarray], Words]:
    """Of each text the sorted distinct hashes of its shingles."""
    words = Words(texts, lower=True)
    runs = words.runs(size)
    short = words.texts_hash(size)
    sets = []
    for i, (first, n) in enumerate(zip(words.first[:-1].tolist(), words.count.tolist(), strict=True)):
        if n >= size:
            sets.append(np.unique(runs[first : first + n - size + 1]))
        else:
            sets.append(short[i : i + 1] if n else short[:0])
    return sets, words


def digest(shingles: np.ndarray) -> bytes:
    return hashlib.blake2b(shingles.tobytes(), digest_size=16).digest()


def registers(sets: list[np.ndarray]) -> np.ndarray:
    """One byte for each register of each set: four bits of leading zeros, four of mantissa."""
    sizes = [len(s) for s in sets]
    flat = np.concatenate(sets) if sets else np.zeros(0, np.uint64)
    row = np.repeat(np.arange(len(sets), dtype=np.int64) * BUCKETS, sizes)
    out = np.empty((len(sets), FUNCTIONS, BUCKETS), np.uint8)
    bits = BUCKETS.bit_length() - 1
    for f in range(FUNCTIONS):  # buckets of a set are its own places of ``least``
        value = flat * _ODD[f]
        value ^= value >> np.uint64(29)
        value *= _ODD[-1 - f]
        least = np.full(len(sets) * BUCKETS, np.iinfo(np.uint64).max, np.uint64)
        at = row + (value >> np.uint64(64 - bits)).astype(np.int64)
        np.minimum.at(least, at, value << np.uint64(bits))
        out[:, f, :] = _compressed(least).reshape(len(sets), BUCKETS)
    return out.reshape(len(sets), REGISTERS)


def _compressed(least: np.ndarray) -> np.ndarray:
    """Leading zeros (up to 15) and the four bits after the first one; a float has them as exponent and fraction."""
    as_float = np.maximum(least, np.uint64(1)).astype(np.float64).view(np.uint64)
    zeros = np.clip(1086 - (as_float >> np.uint64(52)).astype(np.int64), 0, 15)
    return (zeros * 16 + ((as_float >> np.uint64(48)) & np.uint64(15)).astype(np.int64)).astype(np.uint8)


def whole_registers(sets: list[np.ndarray]) -> np.ndarray:
    """Registers of small, not empty sets, each of a function of its own over the whole set."""
    if not sets:
        return np.zeros((0, REGISTERS), np.uint8)
    flat = np.concatenate(sets)
    starts = np.cumsum([0, *[len(s) for s in sets[:-1]]])
    out = np.empty((len(sets), REGISTERS), np.uint8)
    for f, seed in enumerate(_SEEDS):
        out[:, f] = _compressed(np.minimum.reduceat(mixed(flat ^ seed), starts))
    return out


#: Of each register's code the intervals of the least hash (between 0 and 1) that it stands for; the last zeros take all smaller ones.
_ZEROS, _MANTISSA = (x.ravel() for x in np.indices((61, 16)))
_CODE = np.minimum(_ZEROS, 15) * 16 + _MANTISSA
_LOW, _HIGH = (np.exp2(-1.0 - _ZEROS) * (1 + (_MANTISSA + m) / 16) for m in (0, 1))


def code_shares(n: np.ndarray, whole: bool) -> np.ndarray:
    """The probability of each code (a column) in a register of a set of ``n`` hashes, dealt to buckets or ``whole``."""
    buckets = 1 if whole else BUCKETS
    n = np.asarray(n, np.float64)[:, None]
    shares = np.exp(n * np.log1p(-_LOW / buckets)) - np.exp(n * np.log1p(-np.minimum(_HIGH, 1 - 1e-9) / buckets))
    out = np.zeros((len(n), 256))
    np.add.at(out.T, _CODE, shares.T)
    if not whole:  # an empty bucket has the first code
        out[:, 0] += np.exp(n[:, 0] * np.log1p(-1 / BUCKETS))
    return out


def chance(n_a: np.ndarray, n_b: np.ndarray, whole: bool) -> np.ndarray:
    """The probability that registers of two sets of these sizes agree without a common least hash."""
    out = np.empty(len(n_a))
    for start in range(0, len(n_a), SIZES_AT_ONCE):
        here = slice(start, start + SIZES_AT_ONCE)
        sizes, place = np.unique(np.concatenate([n_a[here], n_b[here]]), return_inverse=True)
        shares = code_shares(sizes, whole)
        a, b = np.split(place, 2)
        out[here] = np.einsum("ij,ij->i", shares[a], shares[b])
    return out


def estimate(a: np.ndarray, b: np.ndarray, by_chance: np.ndarray) -> np.ndarray:
    """Jaccard similarity of pairs of rows of registers, corrected for those that agree ``by_chance``."""
    equal = (a == b).mean(axis=1)
    return np.clip((equal - by_chance) / (1 - by_chance), 0, 1)


def least_estimate(by_chance: np.ndarray) -> np.ndarray:
    """Pairs estimated below this are dropped: the threshold less six standard deviations of an estimate."""
    similar = SIMILAR[0] / SIMILAR[1]
    equal = similar + (1 - similar) * by_chance
    return similar - 6 * np.sqrt(equal * (1 - equal) / REGISTERS) / (1 - by_chance)


def parity(shingles: np.ndarray) -> np.ndarray:
    """For each of PARITY_BITS residues whether an odd number of hashes has it, as 64-bit numbers.

    The parities of two sets differ in no more bits than their symmetric difference has shingles.
    """
    odd = np.bincount((shingles >> np.uint64(40)) % np.uint64(PARITY_BITS), minlength=PARITY_BITS).astype(np.uint8) & 1
    return np.packbits(odd).view("<i8")


def _sketch(size: int):
    def sketch(batches):
        for batch in batches:
            for part in chunks(batch, batch.column("text"), CHUNK_BYTES):
                sets, _ = shingles(part.column("text"), size)
                named = [i.is_valid for i in part.column("doc_id")]
                large = [i for i, s in enumerate(sets) if len(s) > SMALL]
                small = [i for i, s in enumerate(sets) if _small(len(s))]
                kept = [b""] * len(sets)
                for which, rows in ((large, registers), (small, whole_registers)):
                    for i, row in zip(which, rows([sets[i] for i in which]), strict=True):
                        kept[i] += row.tobytes()
                yield pa.RecordBatch.from_arrays(
                    [
                        part.column("doc_id"),
                        pa.array([len(s) for s in sets], pa.int32()),
                        pa.array([digest(s) if len(s) and ok else None for s, ok in zip(sets, named, strict=True)], pa.binary()),
                        pa.array(kept, pa.binary()),
                        pa.array([parity(s) for s in sets], pa.list_(pa.int64())),
                    ],
                    ["doc_id", "n", "digest", "registers", "parity"],
                )

    return sketch


def _small(n):
    """Whether a set of this size may be similar to one of at most SMALL."""
    return (n > 0) & (n * SIMILAR[0] <= SMALL * SIMILAR[1])


def _rows(data: list[bytes], n: np.ndarray, which: np.ndarray, small: bool) -> np.ndarray:
    """Registers of one kind; those of the whole set stand after those of buckets, where there are both."""
    at = [REGISTERS * int(small and n[i] > SMALL) for i in which]
    return np.frombuffer(b"".join(data[i][k : k + REGISTERS] for i, k in zip(which, at, strict=True)), np.uint8).reshape(
        len(which), REGISTERS
    )


def _keys(batch: pa.RecordBatch) -> tuple[np.ndarray, np.ndarray]:
    """Keys of the classes of a batch, and of each key the class's place in the batch."""
    data = batch.column("registers").to_pylist()
    n = batch.column("n").to_numpy(zero_copy_only=False)
    keys, places = [np.zeros(0, np.uint64)], [np.zeros(0, np.int64)]
    for small, which in ((False, np.flatnonzero(n > SMALL)), (True, np.flatnonzero(_small(n)))):
        rows = _rows(data, n, which, small).reshape(len(which), BANDS, ROWS)
        packed = np.zeros((len(which), BANDS), np.uint64)
        for r in range(ROWS):
            packed = (packed << np.uint64(8)) | rows[:, :, r]
        band = np.arange(1, BANDS + 1, dtype=np.uint64) + np.uint64(1000 * small)
        keys.append(mixed(packed ^ mixed(band)[None, :]).ravel())
        places.append(np.repeat(which, BANDS))
    return np.concatenate(keys), np.concatenate(places)


_BUCKET = "route bigint, known boolean, bucket bigint, class bigint"


def _gathered(keys: np.ndarray, classes: pa.Array) -> pa.RecordBatch:
    """Keys of a task: one row for each that goes to the key, the others known to share it go on as they are."""
    order = np.argsort(keys, kind="stable")
    keys, classes = keys[order], classes.take(pa.array(order))
    same = keys[1:] == keys[:-1]
    first = np.concatenate([[True], ~same])
    shared = np.concatenate([[False], same]) | np.concatenate([same, [False]])
    away = mixed(keys + np.arange(1, len(keys) + 1, dtype=np.uint64))
    return pa.RecordBatch.from_arrays(
        [
            pa.array(np.where(first, keys, away).view(np.int64)),
            pa.array(shared),
            pa.array(keys.view(np.int64)),
            classes,
        ],
        ["route", "known", "bucket", "class"],
    )


def _buckets(batches):
    keys, classes, size = [], [], 0
    for batch in batches:
        for start in range(0, batch.num_rows, GATHER_KEYS // BANDS):
            part = batch.slice(start, GATHER_KEYS // BANDS)
            found, places = _keys(part)
            keys.append(found)
            classes.append(part.column("class").take(pa.array(places)))
            size += len(found)
            if size >= GATHER_KEYS:
                yield _gathered(np.concatenate(keys), pa.concat_arrays(classes))
                keys, classes, size = [], [], 0
    if size:
        yield _gathered(np.concatenate(keys), pa.concat_arrays(classes))


def _estimated(batches):
    """Pairs that may be similar; the columns are a, b, and the registers and sizes of both."""
    for batch in batches:
        n = [batch.column(c).to_numpy(zero_copy_only=False) for c in ("n_a", "n_b")]
        data = [batch.column(c).to_pylist() for c in ("registers_a", "registers_b")]
        keep = np.minimum(*n) * SIMILAR[1] >= np.maximum(*n) * SIMILAR[0]
        small = _small(np.maximum(*n))  # sets of such sizes as pass both have registers of one kind
        for kind in (False, True):
            which = np.flatnonzero(keep & (small == kind))
            if len(which):
                rows = [_rows(d, m, which, kind) for d, m in zip(data, n, strict=True)]
                by_chance = chance(*[m[which] for m in n], kind)
                keep[which] = estimate(*rows, by_chance) >= least_estimate(by_chance)
        yield batch.select(["a", "b"]).filter(pa.array(keep))


def _confirmed(batches):
    """Pairs whose whole sets are similar; the columns are a, b and both sets."""
    for batch in batches:
        keep = []
        for a, b in zip(batch.column("set_a"), batch.column("set_b"), strict=True):
            x, y = (np.frombuffer(s.as_buffer(), np.uint64) for s in (a, b))
            common = len(np.intersect1d(x, y, assume_unique=True))
            keep.append(SIMILAR[1] * common >= SIMILAR[0] * (len(x) + len(y) - common))
        yield batch.select(["a", "b"]).filter(pa.array(keep, pa.bool_()))


def _sets(size: int):
    def sets(batches):
        for batch in batches:
            for part in chunks(batch, batch.column("text"), CHUNK_BYTES):
                found, _ = shingles(part.column("text"), size)
                digests = pa.array([digest(s) for s in found], pa.binary())
                whole = pa.array([s.tobytes() for s in found], pa.binary())
                out = pa.RecordBatch.from_arrays([part.column("class"), whole], ["class", "set"])
                yield out.filter(pc.equal(digests, part.column("digest")))

    return sets


def _paired(pairs: DataFrame, rows: DataFrame, columns: list[str]) -> DataFrame:
    """Pairs (a, b) with columns of ``rows`` for both, under names ending in _a and _b."""
    for side in ("a", "b"):
        named = rows.select(F.col("class").alias(side), *[F.col(c).alias(f"{c}_{side}") for c in columns])
        pairs = pairs.join(named, side)
    return pairs


def _links(buckets: DataFrame, classes: DataFrame, sets: DataFrame) -> DataFrame | None:
    """Rows (node, label) of the classes that are linked with a smaller one."""
    spark = buckets.sparkSession
    labels = None
    pivots = 1
    priority = F.pmod(F.xxhash64("class"), F.lit(1 << 40)) / float(1 << 40)
    while True:
        rows = buckets
        if labels is None:
            rows = rows.withColumn("label", F.col("class"))
        else:
            rows = rows.join(labels.withColumnRenamed("node", "class"), "class", "left")
            rows = rows.withColumn("label", F.coalesce("label", "class"))
        sizes = rows.groupBy("bucket").agg(
            F.count("*").alias("size"), F.min("label").alias("least"), F.max("label").alias("most"), F.min("class").alias("lead")
        )
        rows = table(rows.join(sizes.where("least <> most").drop("least", "most"), "bucket"), "open-buckets")
        largest = rows.agg(F.max("size")).first()[0]
        if largest is None:
            return labels
        chosen = rows.where((F.col("class") == F.col("lead")) | (priority * F.col("size") < pivots - 1))
        if pivots > 1:  # many pairs that no link joins: those whose parities differ too much are not made
            known = classes.select("class", "n", "parity")
            rows, chosen = (x.join(known, "class") for x in (rows, chosen))
        chosen = chosen.select(
            "bucket",
            F.col("class").alias("pivot"),
            F.col("label").alias("pivot_label"),
            *[F.col(c).alias(f"pivot_{c}") for c in ("n", "parity") if pivots > 1],
        )
        pairs = rows.join(chosen, "bucket").where("label <> pivot_label")
        if pivots > 1:
            words = [F.bit_count(F.col("parity")[i].bitwiseXOR(F.col("pivot_parity")[i])) for i in range(PARITY_BITS // 64)]
            apart = reduce(add, words) * (SIMILAR[0] + SIMILAR[1])
            pairs = pairs.where(apart <= (F.col("n") + F.col("pivot_n")) * (SIMILAR[1] - SIMILAR[0]))
        pairs = pairs.select(F.least("class", "pivot").alias("a"), F.greatest("class", "pivot").alias("b")).distinct()
        # Written, so that a task never has two Python steps, whose workers would stand beside each other.
        near = table(_paired(pairs, classes, ["n", "registers"]).mapInArrow(tidy(_estimated), "a bigint, b bigint"), "near")
        links = _paired(near, sets, ["set"]).mapInArrow(tidy(_confirmed), "a bigint, b bigint")
        if labels is not None:
            for side in ("a", "b"):
                named = labels.select(F.col("node").alias(side), F.col("label").alias(f"label_{side}"))
                links = links.join(named, side, "left").withColumn(side, F.coalesce(f"label_{side}", side)).drop(f"label_{side}")
        found = components(links)
        if not found.isEmpty():
            if labels is not None:
                onward = found.select(F.col("node").alias("label"), F.col("label").alias("to"))
                moved = labels.join(onward, "label", "left").select("node", F.coalesce("to", "label").alias("label"))
                found = moved.unionByName(found.join(labels, "node", "left_anti"))
            labels = table(found, "labels")
        if pivots > largest:
            return labels
        buckets = rows.select("bucket", "class")
        pivots *= GROWTH


def clusters(docs: DataFrame, *, id_col: str = "doc_id", text_col: str = "text", shingle: int = SHINGLE) -> DataFrame:
    """Per document: doc_id, n_shingles, component_id, kept (whether it has the smallest id of its component)."""
    plain = texts(docs, id_col, text_col)
    sketches = table(plain.mapInArrow(tidy(_sketch(shingle)), _sketch_schema(plain)), "sketches")
    classes = sketches.where("digest is not null").groupBy("digest").agg(
        F.min("doc_id").alias("doc_id"), F.any_value("n").alias("n"), F.any_value("registers").alias("registers"), F.any_value("parity").alias("parity")
    )
    # Numbers, which tasks sort and add up with less than digests; the table that is written fixes them.
    classes = table(classes.withColumn("class", F.monotonically_increasing_id()), "classes")
    gathered = classes.select("class", "n", "registers").mapInArrow(tidy(_buckets), _BUCKET)
    route = W.partitionBy("route")
    buckets = gathered.withColumns({"size": F.count("*").over(route), "any": F.max("known").over(route)})
    buckets = table(buckets.where("any or size > 1").select("bucket", "class"), "buckets")
    wanted = buckets.select("class").distinct()
    heads = classes.join(wanted, "class", "left_semi").select("doc_id", "class", "digest")
    sets = plain.join(heads, "doc_id").select("class", "digest", "text").mapInArrow(tidy(_sets(shingle)), "class bigint, set binary")
    # A class may have come from a row among several with this id; each set is needed once.
    sets = table(sets.groupBy("class").agg(F.any_value("set").alias("set")), "sets")
    labels = _links(buckets, classes, sets)
    members = classes.select("class", "digest", F.col("doc_id").alias("component_id"))
    if labels is not None:
        members = members.join(labels.withColumnRenamed("node", "class"), "class", "left")
        members = members.withColumn("label", F.coalesce("label", "class"))
        least = members.groupBy("label").agg(F.min("component_id").alias("component_id"))
        members = members.select("digest", "label").join(least, "label")
    members = members.select("digest", "component_id")
    found = sketches.select("doc_id", F.col("n").cast("bigint").alias("n_shingles"), "digest").join(members, "digest", "left")
    component = F.when(F.col("digest").isNull(), F.col("doc_id")).otherwise(F.col("component_id"))
    return found.select(
        "doc_id", "n_shingles", component.alias("component_id"), (F.col("doc_id").isNull() | (F.col("doc_id") == component)).alias("kept")
    )


def _sketch_schema(plain: DataFrame) -> str:
    return _SKETCH.replace("doc_id bigint", f"doc_id {dict(plain.dtypes)['doc_id']}")


def drop_near_duplicates(docs: DataFrame, *, id_col: str = "doc_id", text_col: str = "text", shingle: int = SHINGLE) -> DataFrame:
    """The documents, in all their columns, that represent their group.

    Rows with one id are one document and stay or go together; rows whose id is null all stay.
    """
    kept = clusters(docs, id_col=id_col, text_col=text_col, shingle=shingle).where("kept and doc_id is not null")
    kept = kept.select(F.col("doc_id")).distinct()
    key = column(docs, id_col)
    return docs.join(kept, key == kept["doc_id"], "left_semi").unionByName(docs.where(key.isNull()))
