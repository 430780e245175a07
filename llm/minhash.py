"""Near-duplicate documents by b-bit MinHash.

Of every document's distinct word shingles, ``bands x rows`` minima are taken. Full minima make the
band keys; for the comparison only ``bits`` of a mixed hash of each minimum are kept, packed into words.
Candidates share a band key; their packed signatures are compared by bit counts and the share of
equal values, corrected for chance equality, estimates the similarity. Candidates whose estimate
lies no more than five deviations below the threshold are confirmed on the full shingle sets of
their whole texts.

Documents with the same shingle set become one before banding. In a bucket, every member is first
compared with the smallest one, which needs as many pairs as the bucket has members; components of
the links found are formed. Buckets that still hold several components are cut into tiles of bounded
size, where signatures of different components are compared in place; only the few pairs that pass
leave the tile. So a large group of copies costs no pair list, and no link between components is
lost.
"""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from llm.graph import components
from llm.shipping import ready
from llm.textbatch import chunks, map_rows, mix, prefix_sums, row_counts, span_hashes, word_spans


@dataclass(frozen=True)
class Settings:
    """Links need ``100 * intersection >= percent * union``.

    With 64 bands of 6 rows a pair at exactly 75 per cent shares no band with probability 4e-6.
    Signatures keep ``bits`` (a divisor of 64) of the mixed hash of ``values`` minima, the first of
    which make the bands; a pair at the threshold fails the estimate with probability 3e-7, whatever
    the size of its sets. ``block`` bounds the
    members of a bucket that are compared at once.
    """

    shingle: int = 5
    percent: int = 75
    bands: int = 64
    rows: int = 6
    values: int = 1024
    bits: int = 2
    deviations: float = 5.0
    block: int = 1024
    seed: int = 11

    @property
    def least_estimate(self) -> float:
        """So many deviations of the corrected estimate below the threshold."""

        chance, share = 0.5**self.bits, self.percent / 100
        equal = share + (1 - share) * chance
        return share - self.deviations * (equal * (1 - equal) / self.values) ** 0.5 / (1 - chance)

    @property
    def marks(self) -> int:
        """A word with the lowest bit of every packed value set."""

        return sum(1 << place for place in range(0, 64, self.bits))


def lower_ascii(data: np.ndarray) -> np.ndarray:
    lowered = data.copy()
    lowered[(data >= 65) & (data <= 90)] |= 32
    return lowered


def shingles(data: np.ndarray, offsets: np.ndarray, size: int) -> tuple[np.ndarray, np.ndarray]:
    """(64-bit shingle hashes in text order, row of each); a short text is one shingle."""

    starts, ends, rows = word_spans(data, offsets)
    n = len(offsets) - 1
    if not len(starts):
        return np.zeros(0, np.uint64), np.zeros(0, np.int64)
    words = span_hashes(prefix_sums(lower_ascii(data)), starts, ends)
    factors = mix(np.arange(1, size + 1, dtype=np.uint64)) | np.uint64(1)
    counts = row_counts(rows, n)
    first = np.cumsum(counts) - counts
    place = np.arange(len(words)) - first[rows]
    left = counts[rows] - place  # words from here to the end of the row
    padded = np.concatenate([words, np.zeros(size, np.uint64)])
    total = words * factors[0]
    short = counts[rows] < size
    for k in range(1, size):
        part = padded[k : k + len(words)] * factors[k]
        if short.any():
            part[short & (left <= k)] = 0
        total += part
    begins = (left >= size) | (short & (place == 0))
    total[short] += counts[rows][short].astype(np.uint64) * np.uint64(0xA24BAED4963EE407)
    return mix(total[begins]), rows[begins]


def _sketch(settings: Settings):
    rng = np.random.default_rng(settings.seed)
    factors = rng.integers(0, 1 << 32, settings.values, dtype=np.uint64).astype(np.uint32) | np.uint32(1)
    shifts = rng.integers(0, 1 << 32, settings.values, dtype=np.uint64).astype(np.uint32)
    salts = mix(np.arange(1, settings.values + 1, dtype=np.uint64))

    def sketch(batch: pa.RecordBatch):
        for low, high, data, offsets, _ in chunks(batch.column("text")):
            rows_here = high - low
            hashes, rows = shingles(data, offsets, settings.shingle)
            counts = row_counts(rows, rows_here)
            distinct, one, two = _set_digests(hashes, counts)
            holds = np.flatnonzero(counts)
            starts = (np.cumsum(counts) - counts)[holds]
            minima = np.zeros((settings.values, len(holds)), np.uint32)
            if len(holds):
                short = (hashes >> np.uint64(32)).astype(np.uint32)
                room = np.empty_like(short)
                for k in range(settings.values):
                    np.multiply(short, factors[k], out=room)
                    np.add(room, shifts[k], out=room)
                    np.minimum.reduceat(room, starts, out=minima[k])
            bands = np.zeros((settings.bands, len(holds)), np.uint64)
            for band in range(settings.bands):  # of the first minima
                key = np.full(len(holds), band + 1, np.uint64)
                for k in range(band * settings.rows, (band + 1) * settings.rows):
                    key = mix(key * np.uint64(0x9E3779B97F4A7C15) + minima[k])
                bands[band] = key
            per_word = 64 // settings.bits
            words = np.zeros((-(-settings.values // per_word), len(holds)), np.uint64)
            mask = np.uint64((1 << settings.bits) - 1)
            for k in range(settings.values):
                # the top bits of a minimum are near zero; its low bits differ alike in every
                # permutation (odd factors keep differences modulo powers of two), so they are mixed
                kept = mix(minima[k] + salts[k]) & mask
                words[k // per_word] |= kept << np.uint64(settings.bits * (k % per_word))
            yield pa.RecordBatch.from_arrays(
                [
                    batch.column("id").slice(low, rows_here),
                    pa.array(distinct),
                    pa.array(one.view(np.int64)),
                    pa.array(two.view(np.int64)),
                    _lists(bands, holds, rows_here),
                    _lists(words, holds, rows_here),
                ],
                ["id", "n", "one", "two", "bands", "signature"],
            )

    return sketch


def _lists(values: np.ndarray, holds: np.ndarray, rows: int) -> pa.Array:
    """A list per row: the column of ``values`` for rows that hold shingles, else empty."""

    sizes = np.zeros(rows, np.int32)
    sizes[holds] = values.shape[0]
    offsets = np.concatenate([[0], np.cumsum(sizes)]).astype(np.int32)
    return pa.ListArray.from_arrays(pa.array(offsets), pa.array(np.ascontiguousarray(values.T).reshape(-1).view(np.int64)))


def _set_digests(hashes: np.ndarray, counts: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Per row: number of distinct hashes and two 64-bit sums over them."""

    n = len(counts)
    distinct, one, two = np.zeros(n, np.int64), np.zeros(n, np.uint64), np.zeros(n, np.uint64)
    ends = np.cumsum(counts)
    large = counts > 50_000  # sorted by themselves, on all 64 bits
    rows = np.repeat(np.arange(n), counts)
    parts = [(low, low + 60_000) for low in range(0, n, 60_000)]
    for low, high in parts:
        inside = hashes[(ends[low - 1] if low else 0) : ends[min(high, n) - 1]]
        own = rows[(ends[low - 1] if low else 0) : ends[min(high, n) - 1]]
        if large.any():
            small = ~large[own]
            inside, own = inside[small], own[small]
        if not len(inside):
            continue
        # the row above 48 bits of the hash: one sort brings equal shingles of a row together
        keys = np.sort(((own - low).astype(np.uint64) << np.uint64(48)) | (inside >> np.uint64(16)))
        keys = keys[np.concatenate([[True], keys[1:] != keys[:-1]])]
        at = (keys >> np.uint64(48)).astype(np.int64)
        value = keys & np.uint64((1 << 48) - 1)
        first = np.flatnonzero(np.concatenate([[True], at[1:] != at[:-1]]))
        place = at[first] + low
        distinct[place] = np.diff(np.append(first, len(at)))
        one[place] = np.add.reduceat(mix(value.copy()), first)
        two[place] = np.add.reduceat(mix(value ^ np.uint64(0x5851F42D4C957F2D)), first)
    for row in np.flatnonzero(large):
        value = np.unique(hashes[ends[row] - counts[row] : ends[row]])
        distinct[row] = len(value)
        value = np.unique(value >> np.uint64(16))
        one[row] = mix(value.copy()).sum()
        two[row] = mix(value ^ np.uint64(0x5851F42D4C957F2D)).sum()
    return distinct, one, two


def signatures(documents: DataFrame, id_col: str, text_col: str, settings: Settings = Settings()) -> DataFrame:
    """id, set size, set digest, band keys and packed low bits of every row with an id."""

    source = documents.select(F.col(id_col).alias("id"), F.col(text_col).cast("string").alias("text")).where("id is not null")
    id_type = source.schema["id"].dataType.simpleString()
    schema = f"id {id_type}, n long, one long, two long, bands array<long>, signature array<long>"
    return map_rows(source, _sketch(settings), schema)


def estimate(left: str, right: str, settings: Settings) -> F.Column:
    """Similarity from two packed signatures, corrected for chance equality of ``bits`` bits."""

    def differing(x: F.Column, y: F.Column) -> F.Column:
        x = x.bitwiseXOR(y)
        step = 1
        while step < settings.bits:  # gather the bits of a value in its lowest one
            x = x.bitwiseOR(F.shiftrightunsigned(x, step))
            step *= 2
        return F.bit_count(x.bitwiseAND(F.lit(settings.marks)))

    unequal = F.aggregate(F.zip_with(left, right, differing), F.lit(0), lambda total, x: total + x)
    chance = 0.5**settings.bits
    return ((1 - unequal / F.lit(float(settings.values))) - chance) / (1 - chance)


def _near_in_buckets(settings: Settings):
    """Pairs of a tile in different components that the estimate lets through.

    The rows of a tile follow each other; a pair that shares several buckets comes from the one with
    the smallest key.
    """

    chance, marks = 0.5**settings.bits, np.uint64(settings.marks)

    def near(one: np.ndarray, two: np.ndarray) -> np.ndarray:
        x = one ^ two
        step = 1
        while step < settings.bits:
            x |= x >> np.uint64(step)
            step *= 2
        unequal = np.bitwise_count(x & marks).sum(1, dtype=np.int64)
        return ((1 - unequal / settings.values) - chance) / (1 - chance) >= settings.least_estimate

    def tiles(rows: pa.RecordBatch) -> pa.RecordBatch:
        column = {name: rows.column(name) for name in rows.schema.names}
        key, i, j, block, root, size = (column[name].to_numpy() for name in ("key", "i", "j", "block", "root", "n"))
        signature = column["signature"].flatten().to_numpy().view(np.uint64).reshape(rows.num_rows, -1)
        keys, bounds = column["keys"].flatten().to_numpy(), column["keys"].offsets.to_numpy()
        bounds = bounds - bounds[0]
        ends = _group_ends(key, i, j)
        last = np.repeat(ends, np.diff(np.concatenate([[0], ends])))
        partners = last - 1 - np.arange(rows.num_rows)
        total = np.concatenate([[0], np.cumsum(partners)])
        found_a, found_b = [], []
        low = 0
        while low < rows.num_rows:
            high = max(low + 1, int(np.searchsorted(total, total[low] + 100_000, side="right")) - 1)
            a = np.repeat(np.arange(low, high), partners[low:high])
            b = a + 1 + np.arange(len(a)) - np.repeat(total[low:high] - total[low], partners[low:high])
            ask = (root[a] != root[b]) & ((i[a] == j[a]) | (block[a] != block[b]))
            ask &= 100 * np.minimum(size[a], size[b]) >= settings.percent * np.maximum(size[a], size[b])
            a, b = a[ask], b[ask]
            for part in range(0, len(a), 20_000):
                x, y = a[part : part + 20_000], b[part : part + 20_000]
                passed = near(signature[x], signature[y])
                found_a.append(x[passed])
                found_b.append(y[passed])
            low = high
        a, b = (np.concatenate([np.zeros(0, np.int64), *x]).astype(np.int64) for x in (found_a, found_b))
        sets: dict[int, frozenset] = {}

        def own(row: int) -> frozenset:
            if row not in sets:
                sets[row] = frozenset(keys[bounds[row] : bounds[row + 1]].tolist())
            return sets[row]

        first = np.fromiter((min(own(x) & own(y)) == key[x] for x, y in zip(a.tolist(), b.tolist(), strict=True)), bool, len(a))
        ids = column["id"]
        return pa.RecordBatch.from_arrays([ids.take(pa.array(a[first])), ids.take(pa.array(b[first]))], ["a", "b"])

    def each(batches):
        held = None
        for batch in batches:
            if held is not None:
                batch = pa.concat_batches([held, batch])
            if not batch.num_rows:
                continue
            ends = _group_ends(*(batch.column(name).to_numpy() for name in ("key", "i", "j")))
            cut = int(ends[-2]) if len(ends) > 1 else 0
            if cut:
                yield tiles(_compact(batch.slice(0, cut)))
            held = _compact(batch.slice(cut))
        if held is not None and held.num_rows:
            yield tiles(held)

    return each


def _compact(batch: pa.RecordBatch) -> pa.RecordBatch:
    """The same rows in buffers of their own."""

    return batch.take(pa.array(np.arange(batch.num_rows)))


def _group_ends(*columns: np.ndarray) -> np.ndarray:
    changed = np.zeros(len(columns[0]) - 1, bool)
    for values in columns:
        changed |= values[1:] != values[:-1]
    return np.append(np.flatnonzero(changed) + 1, len(columns[0]))


def _confirm(settings: Settings):
    """Keep the pairs whose full shingle sets are similar enough.

    Rows are sorted by ``a`` and ``piece``; the text of ``a`` itself (null ``b``) leads its members, so
    its set is made once for all of them.
    """

    def sets(column: pa.Array):
        for _, _, data, offsets, _ in chunks(column):
            hashes, rows = shingles(data, offsets, settings.shingle)
            ends = np.cumsum(row_counts(rows, len(offsets) - 1))
            for row in range(len(offsets) - 1):
                yield np.unique(hashes[(ends[row - 1] if row else 0) : ends[row]])

    def similar(one: np.ndarray, two: np.ndarray) -> bool:
        common = len(np.intersect1d(one, two, assume_unique=True))
        return 100 * common >= settings.percent * (len(one) + len(two) - common) and common > 0

    def each(batches):
        owner, leads = None, []  # several when one id has several texts
        for batch in batches:
            linked = np.zeros(batch.num_rows, bool)
            keys = zip(batch.column("a").to_pylist(), batch.column("piece").to_pylist(), strict=True)
            heads = np.asarray(batch.column("b").is_null())
            for i, (key, own) in enumerate(zip(keys, sets(batch.column("text")), strict=True)):
                if key != owner:
                    owner, leads = key, []
                if heads[i]:
                    leads.append(own)
                else:
                    linked[i] = any(similar(lead, own) for lead in leads)
            yield pa.RecordBatch.from_arrays([batch.column("a"), batch.column("b")], ["src", "dst"]).filter(pa.array(linked))

    return each


def _pieces(df: DataFrame) -> int:
    """Into how many pieces a large group is split: as many as a shuffle has partitions."""

    return max(8, int(df.sparkSession.conf.get("spark.sql.shuffle.partitions")))


def spread_join(rows: DataFrame, facts: DataFrame, keys: list[str], by: str, how: str = "inner") -> DataFrame:
    """Join ``rows`` to the few ``facts`` of each key, where one key may hold a large share of the rows.

    Rows of a key are split by the hash of ``by``; facts are repeated for the pieces that occur, so
    no task meets more than a piece of a key.
    """

    split = rows.withColumn("piece", F.pmod(F.xxhash64(by), F.lit(_pieces(rows))).cast("int"))
    wanted = split.select(*keys, "piece").distinct().join(facts, keys)
    return split.join(wanted, [*keys, "piece"], how).drop("piece")


def _hot_keys(marks: DataFrame, settings: Settings) -> DataFrame:
    """Band keys that hold an unusual share of a 64th of the documents.

    They only decide how rows are spread. A key needs a thousandth of the sample or more, so there
    are at most 1000 times ``bands`` of them at any size.
    """

    part = marks.where((F.pmod(F.xxhash64(F.lit("hot"), "id"), F.lit(64)) == 0) & (F.col("n") > 0))
    least = max(16, part.count() // min(1000, _pieces(marks)))
    return part.select(F.explode("bands").alias("key")).groupBy("key").count().where(F.col("count") >= least).select("key").checkpoint()


def _extent(rows: DataFrame, column: str, hot: DataFrame) -> DataFrame:
    """Rows (id, key, ...) with the least and greatest ``column`` and the number of rows of their key.

    Hot keys are aggregated before the shuffle and known to all tasks (their number is bounded),
    their rows are then spread; other keys take one window.
    """

    def over(frame):
        return [(f"_{name}", frame(value)) for name, value in (("low", F.min(column)), ("high", F.max(column)), ("size", F.count("*")))]

    large = rows.join(F.broadcast(hot), "key").groupBy("key").agg(*[value.alias(f"{name}_hot") for name, value in over(lambda x: x)])
    spread = rows.join(F.broadcast(large), "key", "left")
    piece = F.when(F.col("_size_hot").isNull(), 0).otherwise(F.pmod(F.xxhash64("id"), F.lit(_pieces(rows))))
    whole = Window.partitionBy("key", "_piece")
    found = spread.withColumn("_piece", piece).select("*", *[value.alias(name) for name, value in over(lambda x: x.over(whole))])
    return found.select(*rows.columns, *[F.coalesce(f"_{x}_hot", f"_{x}").alias(x) for x in ("low", "high", "size")])


def near_duplicates(documents: DataFrame, id_col: str = "doc_id", text_col: str = "text", settings: Settings = Settings()) -> DataFrame:
    """One row per id: id, ``n_shingles``, ``component_id``, ``kept``.

    Documents with no word or no text have size 0, link with nothing and are kept. Rows without an
    id are left out. Rows with the same id are one document; if their texts differ, it links as any
    of them and has the largest size. Columns besides id and text are not read.
    """

    ready(documents.sparkSession)
    marks = signatures(documents, id_col, text_col, settings).checkpoint()
    parts = max(1, marks.rdd.getNumPartitions())

    def fixed(df: DataFrame) -> DataFrame:
        """A checkpoint in no more partitions than the documents came in, since it holds no more than they do.

        Every task over a checkpoint leaves files of its own, however few its rows are.
        """

        return df.coalesce(parts).checkpoint()

    sizes = marks.select("id", "n", "one", "two")
    split = sizes.where("n > 0").withColumn("piece", F.pmod(F.xxhash64("id"), F.lit(_pieces(marks))).cast("int"))
    digest = ["n", "one", "two"]
    classes = split.groupBy(*digest).agg(F.min("id").alias("rep"), F.collect_set("piece").alias("pieces"))
    first = marks.join(classes.select("n", "one", "two", F.col("rep").alias("id")), ["n", "one", "two", "id"], "left_semi")
    first = first.dropDuplicates(["id", "n", "one", "two"])

    buckets = first.select("id", F.explode("bands").alias("key"))
    hot = _hot_keys(marks, settings)
    shared = _extent(buckets, "id", hot).where("low <> high").select("id", "key", F.col("low").alias("lead"))
    shared = fixed(shared)

    candidates = shared.select("id").distinct()
    known = fixed(first.join(candidates, "id", "left_semi").select("id", "n", "signature"))
    texts = documents.select(F.col(id_col).alias("id"), F.col(text_col).cast("string").alias("text"))
    texts = fixed(texts.join(candidates, "id", "left_semi"))

    stars = shared.where("id <> lead").select(F.col("lead").alias("a"), F.col("id").alias("b")).distinct()
    links = fixed(_confirmed(_estimated(stars, known, settings), texts, settings))
    joined = components(links, parts)

    # What the stars left apart: members of a bucket in different components, in tiles.
    placed = shared.select("id", "key").join(joined.withColumnRenamed("node", "id"), "id", "left")
    placed = placed.select("id", "key", F.coalesce("root", "id").alias("root"))
    apart = _extent(placed, "root", hot).where("low <> high").select("id", "key", "root", F.ceil(F.col("size") / settings.block).cast("int").alias("blocks"))
    apart = fixed(apart)
    keys = apart.groupBy("id").agg(F.collect_list("key").alias("keys"))  # at most one per band
    rows = apart.join(known.join(keys, "id"), "id").withColumn("block", F.pmod(F.xxhash64("id"), "blocks").cast("int"))
    rows = rows.withColumn("other", F.explode(F.sequence(F.lit(0), F.col("blocks") - 1)))
    rows = rows.select("key", F.least("block", "other").alias("i"), F.greatest("block", "other").alias("j"), "block", "id", "root", "n", "signature", "keys")
    id_type = rows.schema["id"].dataType.simpleString()
    dealt = rows.repartition("key", "i", "j").sortWithinPartitions("key", "i", "j")
    near = _smaller_first(dealt.mapInArrow(_near_in_buckets(settings), f"a {id_type}, b {id_type}"))
    more = _confirmed(near, texts, settings)

    # One document with several texts links them.
    wanted = classes.select(*digest, F.explode("pieces").alias("piece"), "rep")  # no task meets more than a piece of a class
    members = fixed(split.join(wanted, [*digest, "piece"]).select("id", "n", "rep"))
    several = members.groupBy("id").agg(F.min("rep").alias("lo"), F.max("rep").alias("hi")).where("lo <> hi").select("id", "lo")
    same = members.join(several, "id").where("rep <> lo").select(F.col("rep").alias("src"), F.col("lo").alias("dst"))

    roots = joined.where("node <> root").select(F.col("node").alias("src"), F.col("root").alias("dst"))
    final = components(roots.unionByName(more).unionByName(same), parts)
    placed = spread_join(members, final.withColumnRenamed("node", "rep"), ["rep"], "id", "left")
    placed = placed.select("id", "n", F.coalesce("root", "rep").alias("root"))
    empty = sizes.where("n = 0").select("id", "n", F.lit(None).cast(placed.schema["root"].dataType).alias("root"))
    found = placed.unionByName(empty).groupBy("id").agg(F.max("n").alias("n_shingles"), F.min("root").alias("root"))
    component = F.coalesce("root", "id")
    return found.select(
        F.col("id").alias(id_col), "n_shingles", component.alias("component_id"), (component == F.col("id")).alias("kept")
    )


def _estimated(pairs: DataFrame, known: DataFrame, settings: Settings) -> DataFrame:
    """The pairs (a, b) that sizes and signatures let through."""

    a = known.select(F.col("id").alias("a"), F.col("n").alias("n_a"), F.col("signature").alias("sig_a"))
    b = known.select(F.col("id").alias("b"), F.col("n").alias("n_b"), F.col("signature").alias("sig_b"))
    near = spread_join(pairs, a, ["a"], "b").join(b, "b")
    near = near.where(100 * F.least("n_a", "n_b") >= settings.percent * F.greatest("n_a", "n_b"))
    return near.where(estimate("sig_a", "sig_b", settings) >= settings.least_estimate).select("a", "b").distinct()


def _smaller_first(pairs: DataFrame) -> DataFrame:
    """Pairs in an order of their own: that of a tile's rows may be another each time they are fetched."""

    return pairs.select(F.least("a", "b").alias("a"), F.greatest("a", "b").alias("b"))


def _confirmed(near: DataFrame, texts: DataFrame, settings: Settings) -> DataFrame:
    """(src, dst) of the pairs (a, b) that the full sets confirm.

    The text of ``a`` moves once for each piece of its partners, not once for every partner.
    """

    pairs = near.withColumn("piece", F.pmod(F.xxhash64("b"), F.lit(_pieces(near))).cast("int"))
    members = pairs.join(texts.withColumnRenamed("id", "b"), "b").select("a", "piece", "b", "text")
    heads = pairs.select("a", "piece").distinct().join(texts.withColumnRenamed("id", "a"), "a")
    heads = heads.select("a", "piece", F.lit(None).cast(members.schema["b"].dataType).alias("b"), "text")
    id_type = members.schema["a"].dataType.simpleString()
    dealt = members.unionByName(heads).repartition("a", "piece").sortWithinPartitions("a", "piece", F.col("b").asc_nulls_first())
    return dealt.mapInArrow(_confirm(settings), f"src {id_type}, dst {id_type}").distinct()
