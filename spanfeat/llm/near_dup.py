"""Near-duplicate groups at an exact Jaccard similarity of five-word shingles, without all pairs.

SimHash fingerprints of the sets of shingles come first: those within 3 bits, found by
vantage-point trees in shards, are candidates. Texts at Jaccard 0.8 differ in about 10 of 64
bits, so an exact search adds what the fingerprints cannot see. Two sets with Jaccard >= 0.8 share a shingle among the first fifth of each, in any order
that is the same for all sets (prefix filter): no pair is given up. The order puts shingles
first that are rare in the corpus, as counted in a hashed table of fixed size, so passages
that many texts share lie outside the prefixes and link nothing. In a bucket of one shingle
each member is compared with the first only. Members of groups that are still apart are then
compared with the next of their bucket, in another order for every shingle and turn, so that
large groups of near copies grow together at a cost in proportion to their rows. Only pairs
across groups that are still apart after that are all compared, but for those whose parities
differ in more places than two sets of 0.8 can have shingles of their own. Pairs are candidates only if sizes and places in the prefixes allow 0.8
(a pair of 0.8 passes at its first common shingle, whatever the others say). All candidates
are confirmed on their whole sets, which are made again from the texts.
"""

from __future__ import annotations

import uuid
from functools import reduce

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from spanfeat.llm.common import release
from spanfeat.llm.flat_text import flat, parts
from spanfeat.llm.shingles import common_counts, shingle_hashes, shingle_sets, slots
from spanfeat.llm.simhash_vp import components, fingerprint_links
from spanfeat.session import staged

# Contract of the pipeline's stage: words per shingle; links need 9 * common >= 4 * (sum of
# sizes), which is Jaccard >= 0.8 in whole numbers.
WIDTH = 5
# Slots of the table of frequencies. Its size bounds what is sent to tasks; it sets the
# order of shingles and so the number of candidates, not which pairs are found.
SLOTS = 1 << 18
# A shingle whose slot holds this many times the mean is dealt over SALTS tasks.
HEAVY, SALTS = 64, 16
# Turns in which members of a bucket are compared with the next, at most; they set how many
# pairs are left for the last step, not which links are found.
TURNS = 2
# Numbers of 64 bits that tell, bit by bit, whether an odd number of a set's shingles fell there.
PARITIES = 4
# Bytes of text whose shingles are worked on at once.
PART = 1 << 20


def frequencies(texts: DataFrame) -> np.ndarray:
    """Shingles of all texts counted by slot; 8 * SLOTS bytes reach the driver, in pieces of one slot range."""
    step = SLOTS >> 4

    def count(batches):
        total = np.zeros(SLOTS, np.int64)
        for batch in batches:
            for part in parts(batch, "text", PART):
                h, _ = shingle_hashes(*flat(part.column("text")), WIDTH)
                total += np.bincount(slots(h, SLOTS), minlength=SLOTS)
        for k in range(0, SLOTS, step):
            own = total[k : k + step]
            if own.any():
                yield pa.RecordBatch.from_arrays(
                    [pa.array([k], pa.int32()), pa.array([own.astype("<i8").tobytes()])], names=["k", "n"]
                )

    def add(key, pdf):
        import pandas as pd

        total = np.zeros(step, np.int64)
        for raw in pdf["n"]:
            total += np.frombuffer(raw, "<i8")
        return pd.DataFrame({"k": [key[0]], "n": [total.tobytes()]})

    made = texts.select("text").mapInArrow(count, "k int, n binary").groupBy("k").applyInPandas(add, "k int, n binary")
    table = np.zeros(SLOTS, np.int64)
    for row in made.collect():
        table[row["k"] : row["k"] + step] = np.frombuffer(row["n"], "<i8")
    return table


def prefixes(texts: DataFrame, table: np.ndarray) -> DataFrame:
    """(sig, salt, id, place, size): the first fifth, and one more, of every set, rarest first.

    ``place`` counts from 0; ``salt`` is -1 but for heavy shingles.
    """
    shared = texts.sparkSession.sparkContext.broadcast(table)  # SLOTS numbers
    limit = HEAVY * max(1.0, float(table.mean()))

    def sign(batches):
        order = shared.value
        for batch in batches:
            for part in parts(batch, "text", PART):
                h, row = shingle_sets(*flat(part.column("text")), WIDTH, order)
                size = np.bincount(row, minlength=part.num_rows)
                first = np.cumsum(size) - size
                place = np.arange(len(h)) - first[row]
                keep = place <= size[row] - (4 * size[row] + 4) // 5
                h, row, place = h[keep], row[keep], place[keep]
                ids = part.column("id").to_numpy()[row]
                salt = np.where(order[slots(h, SLOTS)] > limit, ids % SALTS, -1)
                yield pa.RecordBatch.from_arrays(
                    [
                        pa.array(h.view(np.int64)), pa.array(salt.astype(np.int32)), pa.array(ids),
                        pa.array(place.astype(np.int32)), pa.array(size[row].astype(np.int32)),
                    ],
                    names=["sig", "salt", "id", "place", "size"],
                )

    return texts.select("id", "text").mapInArrow(sign, "sig long, salt int, id long, place int, size int")


def buckets(signed: DataFrame) -> DataFrame:
    """(sig, salt, id, place, size, first, near): members of all (sig, salt) with several ids, and
    the one member of a salted bucket; ``first`` is the smallest id, ``near`` whether sizes and
    places allow 0.8 with it. A task streams over its rows and holds one row of the open bucket."""

    def run(batches):
        held = None  # (sig, salt, id, place, size) of the first row of the open bucket
        told, seen = False, None  # whether that row is out, and the last id

        def out(rows):
            columns = list(zip(*rows)) if rows else [[]] * 7
            types = [pa.int64(), pa.int32(), pa.int64(), pa.int32(), pa.int32(), pa.int64(), pa.bool_()]
            names = ["sig", "salt", "id", "place", "size", "first", "near"]
            return pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(columns, types)], names=names)

        def allowed(p, n):
            return 9 * min(n - p, held[4] - held[3]) >= 4 * (n + held[4])

        for batch in batches:
            sig, salt, ids, place, size = (batch.column(c).to_numpy() for c in ("sig", "salt", "id", "place", "size"))
            n = len(sig)
            if not n:
                continue
            rows = []
            fresh = np.ones(n, bool)
            fresh[1:] = (sig[1:] != sig[:-1]) | (salt[1:] != salt[:-1])
            fresh[0] = held is None or (sig[0], salt[0]) != held[:2]
            # rows that stand alone between two others are passed over without a look
            lone = fresh & np.append(fresh[1:], False) & (salt < 0)
            for k in np.flatnonzero(~lone).tolist():
                if fresh[k]:
                    if held is not None and not told and held[1] >= 0:
                        rows.append((*held, held[2], True))
                    held = (int(sig[k]), int(salt[k]), int(ids[k]), int(place[k]), int(size[k]))
                    told, seen = False, held[2]
                elif ids[k] != seen:
                    if not told:
                        rows.append((*held, held[2], True))
                        told = True
                    seen = int(ids[k])
                    p, n_own = int(place[k]), int(size[k])
                    rows.append((int(sig[k]), int(salt[k]), seen, p, n_own, held[2], allowed(p, n_own)))
            yield out(rows)
        if held is not None and not told and held[1] >= 0:
            yield out([(*held, held[2], True)])

    dealt = signed.repartition("sig", "salt").sortWithinPartitions("sig", "salt", "id")
    return dealt.mapInArrow(run, "sig long, salt int, id long, place int, size int, first long, near boolean")


def confirm(pairs: DataFrame, texts: DataFrame) -> DataFrame:
    """Pairs (a, b) whose texts have Jaccard >= 0.8."""
    one = texts.select(F.col("id").alias("a"), F.col("text").alias("x"))
    two = texts.select(F.col("id").alias("b"), F.col("text").alias("y"))

    def check(batches):
        for batch in batches:
            for part in parts(batch, "x", PART // 2):
                h1, r1 = shingle_sets(*flat(part.column("x")), WIDTH)
                h2, r2 = shingle_sets(*flat(part.column("y")), WIDTH)
                both = common_counts(h1, r1, h2, r2, part.num_rows)
                total = np.bincount(r1, minlength=part.num_rows) + np.bincount(r2, minlength=part.num_rows)
                keep = pa.array(9 * both >= 4 * total)
                yield pa.RecordBatch.from_arrays(
                    [part.column("a").filter(keep), part.column("b").filter(keep)], names=["a", "b"]
                )

    return pairs.join(one, "a").join(two, "b").select("a", "b", "x", "y").mapInArrow(check, "a long, b long")


def fingerprints(texts: DataFrame) -> DataFrame:
    """(id, fp, size, odd0, ...): SimHash of each text's set of shingles, the set's size and parities, once per id."""
    odd = [f"odd{k}" for k in range(PARITIES)]

    def sign(batches):
        for batch in batches:
            for part in parts(batch, "text", PART):
                h, row = shingle_sets(*flat(part.column("text")), WIDTH)
                size = np.bincount(row, minlength=part.num_rows)
                fp = np.zeros(part.num_rows, np.uint64)
                for bit in range(64):
                    ones = np.bincount(row, weights=(h >> np.uint64(bit)) & np.uint64(1), minlength=part.num_rows)
                    fp |= (2 * ones > size).astype(np.uint64) << np.uint64(bit)
                bits = np.zeros((part.num_rows, 64 * PARITIES), np.uint8)
                np.bitwise_xor.at(bits, (row, (h % np.uint64(64 * PARITIES)).astype(np.int64)), 1)
                parities = np.packbits(bits, axis=1).view(np.int64)
                yield pa.RecordBatch.from_arrays(
                    [
                        part.column("id"), pa.array(fp.view(np.int64)), pa.array(size.astype(np.int32)),
                        *[pa.array(np.ascontiguousarray(parities[:, k])) for k in range(PARITIES)],
                    ],
                    names=["id", "fp", "size", *odd],
                )

    schema = ", ".join(["id long, fp long, size int", *[f"{c} long" for c in odd]])
    made = texts.select("id", "text").mapInArrow(sign, schema)
    return made.groupBy("id").agg(*[F.any_value(c).alias(c) for c in ("fp", "size", *odd)])


def simhash_pairs(texts: DataFrame, marks: DataFrame | None = None) -> DataFrame:
    """Pairs (a, b) of ids whose fingerprints are equal or linked within 3 bits, where sizes allow 0.8.

    Texts of one fingerprint meet the first of them; the firsts of linked fingerprints meet
    as the vantage-point trees of the shards link them. ``marks`` are the fingerprints, if at hand.
    """
    marks = (staged(fingerprints(texts), "marks") if marks is None else marks).select("id", "fp", "size")
    first = F.min(F.struct("id", "size")).alias("first")
    prints = staged(marks.groupBy("fp").agg(first).select("fp", "first.id", "first.size"), "prints")
    lead, other = (prints.toDF("fp", c, f"n{c}") for c in ("a", "b"))
    same = marks.toDF("b", "fp", "nb").join(lead, "fp").filter("a <> b")
    found = fingerprint_links(prints).toDF("fa", "fb")
    found = found.join(lead.withColumnRenamed("fp", "fa"), "fa").join(other.withColumnRenamed("fp", "fb"), "fb")
    both = same.select("a", "b", "na", "nb").unionByName(found.select("a", "b", "na", "nb"))
    both = both.filter(9 * F.least("na", "nb") >= 4 * (F.col("na") + F.col("nb")))
    return both.select(F.least("a", "b").alias("a"), F.greatest("a", "b").alias("b"))


def texts_of(pairs: DataFrame, texts: DataFrame) -> DataFrame:
    """(id, text) of the ids in pairs (a, b), once each."""
    ids = staged(pairs.select(F.col("a").alias("id")).unionAll(pairs.select("b")).distinct(), "wanted")
    return staged(texts.join(ids, "id", "left_semi").groupBy("id").agg(F.any_value("text").alias("text")), "near-texts")


def allowed(p: str, n: str, q: str, m: str) -> Column:
    """Whether sets of n and m shingles that share one at places p and q may reach 0.8."""
    reach = F.least(F.col(n) - F.col(p), F.col(m) - F.col(q))
    return 9 * reach >= 4 * (F.col(n) + F.col(m))


def apart(shared: DataFrame, near: DataFrame) -> DataFrame:
    """(sig, salt, id, place, size, root): members of buckets that hold several groups linked by ``near``."""
    group = components(near)
    named = shared.join(group, shared["id"] == group["node"], "left")
    named = named.select("sig", "salt", "id", "place", "size", F.coalesce("root", "id").alias("root"))
    mixed = named.groupBy("sig").agg(F.min("root").alias("lo"), F.max("root").alias("hi")).filter("lo <> hi").select("sig")
    return staged(named.join(mixed, "sig"), "mixed")


def chained(rest: DataFrame, turn: int) -> DataFrame:
    """Pairs (a, b) of members side by side in a bucket whose groups are apart, where sizes and places allow 0.8."""
    order = W.partitionBy("sig", "salt").orderBy(F.xxhash64("id", "sig", F.lit(turn)), "id")
    beside = rest.withColumn("next", F.lead(F.struct("id", "root", "place", "size")).over(order))
    beside = beside.filter("root <> next.root").filter(allowed("place", "size", "next.place", "next.size"))
    return beside.select(F.least("id", "next.id").alias("a"), F.greatest("id", "next.id").alias("b")).distinct()


def links(texts: DataFrame) -> DataFrame:
    """Links (a, b) that join all texts (id, text) connected by Jaccard >= 0.8; ids may repeat with their text."""
    shared = staged(buckets(prefixes(texts, frequencies(texts))), "buckets")
    # members to the first of their bucket, firsts of salted buckets to the first of all
    heads = shared.filter("salt >= 0 AND id = first")
    leads = heads.groupBy("sig").agg(F.min(F.struct("id", "place", "size")).alias("lead"))
    heads = heads.join(leads, "sig").filter("id <> lead.id").filter(allowed("place", "size", "lead.place", "lead.size"))
    star = shared.filter("id <> first AND near").select(F.col("first").alias("a"), F.col("id").alias("b")).unionByName(
        heads.select(F.col("lead.id").alias("a"), F.col("id").alias("b"))
    )
    marks = staged(fingerprints(texts), "marks")
    star = staged(simhash_pairs(texts, marks).unionByName(star).distinct(), "star")
    near = staged(confirm(star, texts_of(star, texts)), "near")
    rest, tried = apart(shared, near), star
    for turn in range(TURNS):
        pairs = staged(chained(rest, turn).join(tried, ["a", "b"], "left_anti"), "chain")
        fresh = staged(confirm(pairs, texts_of(pairs, texts)), "near")
        tried = tried.unionByName(pairs)
        if fresh.isEmpty():
            break
        near = near.unionByName(fresh)
        rest = apart(shared, near)
    odd = [f"odd{k}" for k in range(PARITIES)]
    rest = rest.select("sig", "id", "root", "place", "size").join(marks.select("id", *odd), "id")
    left = rest.toDF("a", "sig", "ra", "pa", "na", *[f"{c}a" for c in odd])
    right = rest.toDF("b", "sig", "rb", "pb", "nb", *[f"{c}b" for c in odd])
    # a shingle of one set alone turns one bit, so this many are not shared at least
    unlike = reduce(Column.__add__, [F.bit_count(F.col(f"{c}a").bitwiseXOR(F.col(f"{c}b"))) for c in odd])
    pairs = left.join(right, "sig").filter("a < b AND ra <> rb").filter(allowed("pa", "na", "pb", "nb"))
    pairs = pairs.filter(9 * unlike <= F.col("na") + F.col("nb"))
    pairs = staged(pairs.select("a", "b").distinct().join(tried, ["a", "b"], "left_anti"), "pairs")
    return near.unionByName(confirm(pairs, texts_of(pairs, texts)))


def keep_first(docs: DataFrame) -> DataFrame:
    """One row of each group of documents linked by five-word Jaccard >= 0.8, with all its columns.

    The row with the smallest doc_id stays (a null one only where the group has no other);
    of rows that repeat it, the smallest by all columns. Equal texts are one by a key of 96
    bits. Texts without words form one group, null among them. Extra columns stay, whatever
    their names; an empty table gives no rows.
    """
    tag = uuid.uuid4().hex[:12]
    id_, check, first, root = (f"{name}_{tag}" for name in ("id", "check", "first", "root"))
    words = F.coalesce(F.col("text").rlike(r"[^\x09-\x0D\x20]"), F.lit(False))
    keyed = docs.withColumns({
        id_: F.when(words, F.xxhash64("text")).otherwise(F.lit(0).cast("long")),
        check: F.when(words, F.hash("text")).otherwise(F.lit(0)),
    })
    counted = staged(keyed.groupBy(id_, check, F.col("doc_id").alias(first)).agg(F.count("*").alias("n")), "counted")
    order = F.struct(F.col(first).isNull(), F.col(first))
    light = counted.groupBy(id_, check).agg(F.min_by(F.struct(first, "n"), order).alias("at"))
    light = staged(light.select(id_, check, f"at.{first}", "at.n"), "texts")
    # texts whose 64-bit keys clash keep apart by the second key
    clash = light.groupBy(id_).agg(F.count("*").alias("k")).filter("k > 1").select(id_, F.lit(True).alias("clash"))
    group = components(links(keyed.filter(words).select(F.col(id_).alias("id"), "text")))
    named = light.join(clash, id_, "left").join(group, F.col(id_) == F.col("node"), "left")
    alone = F.concat_ws(":", F.col(id_).cast("string"), F.col(check).cast("string"))
    named = named.withColumn(root, F.when(F.col("clash"), alone).otherwise(F.coalesce("root", id_).cast("string")))
    best = named.groupBy(root).agg(F.min(F.struct(order, id_, check, first, "n")).alias("best"))
    chosen = staged(best.select(*[F.col(f"best.{c}").alias(f"{c}_kept") for c in (id_, check, first, "n")]), "chosen")
    same = (F.col(id_) == F.col(f"{id_}_kept")) & (F.col(check) == F.col(f"{check}_kept"))
    chosen = chosen.withColumnRenamed("n_kept", f"n_{tag}")
    found = keyed.join(chosen, same & F.col("doc_id").eqNullSafe(F.col(f"{first}_kept")))
    # of rows that repeat the chosen one, the smallest
    again = found.filter(F.col(f"n_{tag}") > 1).groupBy(id_, check).agg(F.min(F.struct(*docs.columns)).alias(root))
    release(counted, light)
    return found.filter(F.col(f"n_{tag}") == 1).select(*docs.columns).unionByName(again.select(f"{root}.*"))
