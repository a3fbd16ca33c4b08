"""Near-duplicates by HyperMinHash: documents whose sets of shingles are similar are linked.

1. A document's shingles become 64-bit hashes. Documents of one set of hashes are one node.
2. Seven bits of a hash choose one of 128 buckets; a bucket keeps the smallest hash that falls into it, compressed to its
   number of leading zeros and the ``MANTISSA`` bits after them. Four registers make a band; nodes that agree in a band meet.
3. Of those that meet, each is compared with the one that meets most others. Verified links make components; inside of
   one nothing more can be gained. Where members of several components still meet, their full sets are searched for
   further links by an exact prefix filter. So no pairs are written within a group of copies, nor among documents that
   share a common line, and no link between components is lost.
4. A comparison asks for sizes that allow the similarity, then for an estimate from the registers, corrected for
   chance collisions, then intersects the full sets.
"""

from __future__ import annotations

import math

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tidemark.llm.common import LARGEST, comparable_id, each_batch, prepared, stored, texts_of
from tidemark.llm.simhash import LOWER, components
from tidemark.llm.substrings import PrefixHashes, mixed

SHINGLE, PERCENT = 4, 80
# At a similarity of 0.8 a band agrees with probability 0.41, none of 32 with 5 in 10**8.
BANDS, ROWS = 32, 4
REGISTERS = BANDS * ROWS
BUCKET_BITS, MANTISSA = 7, 18
REST = 64 - BUCKET_BITS
# Estimates may lie so many standard deviations below the similarity before full sets are spared the comparison.
DEVIATIONS = 5
# Members of a group compared at a time.
BLOCK = 512
# Hashing in stretches of so many bytes; a longer shingle is hashed by itself.
STRETCH_BYTES = 1 << 20


def shingle_hashes(texts: list[bytes], size: int) -> tuple[np.ndarray, np.ndarray]:
    """The distinct hashes of each text's shingles, sorted by text and hash, and the text of each."""
    lines = [b" ".join(t.translate(LOWER).split()) for t in texts]
    words = np.array([t.count(b" ") + 1 if t else 0 for t in lines], dtype=np.int64)
    data = np.frombuffer(b" ".join(t for t in lines if t), dtype=np.uint8)
    if not words.sum():
        return np.zeros(0, dtype=np.uint64), np.zeros(0, dtype=np.int64)
    gaps = np.flatnonzero(data == 32)
    start, end = np.concatenate(([0], gaps + 1)), np.append(gaps, len(data))
    count = np.where(words > 0, np.maximum(words - size + 1, 1), 0)
    owner = np.repeat(np.arange(len(texts)), count)
    before = np.cumsum(words) - words
    first = np.arange(count.sum()) - np.repeat(np.cumsum(count) - count - before, count)
    start, end = start[first], end[first + np.minimum(words[owner], size) - 1]
    hashes = np.zeros(len(start), dtype=np.uint64)
    long = end - start > STRETCH_BYTES
    for i in np.flatnonzero(long).tolist():
        import xxhash

        hashes[i] = xxhash.xxh64_intdigest(data[start[i] : end[i]].tobytes(), 1)
    at = np.flatnonzero(~long)
    while len(at):
        low = start[at[0]]
        n = np.searchsorted(end[at], low + 2 * STRETCH_BYTES, side="right")
        own, at = at[:n], at[n:]
        hashes[own] = mixed(PrefixHashes(data[low : end[own[-1]]]).of(start[own] - low, end[own] - low))
    order = np.lexsort((hashes, owner))
    hashes, owner = hashes[order], owner[order]
    new = np.concatenate(([True], (hashes[1:] != hashes[:-1]) | (owner[1:] != owner[:-1])))
    return hashes[new], owner[new]


def registers(hashes: np.ndarray, owner: np.ndarray, n: int) -> np.ndarray:
    """Registers of ``n`` texts from sorted hashes: leading zeros and mantissa of each bucket's smallest, 0 if it is empty."""
    out = np.zeros((n, REGISTERS), dtype=np.int32)
    bucket = (hashes >> np.uint64(REST)).astype(np.int64)
    cell = owner * REGISTERS + bucket
    least = np.flatnonzero(np.concatenate(([True], cell[1:] != cell[:-1]))) if len(cell) else np.zeros(0, dtype=np.int64)
    rest = hashes[least] & np.uint64((1 << REST) - 1)
    # Bit lengths by halves, since a double cannot hold 57 bits.
    high, low = (rest >> np.uint64(28)).astype(np.float64), (rest & np.uint64((1 << 28) - 1)).astype(np.float64)
    length = np.where(high > 0, np.frexp(high)[1] + 28, np.frexp(low)[1]).astype(np.int64)
    zeros = np.minimum(REST - length, REST - MANTISSA)
    # The bits after the leading one; below MANTISSA bits what there is.
    below = np.maximum(length - 1, MANTISSA) - MANTISSA
    mantissa = (rest >> below.astype(np.uint64)) & np.uint64((1 << MANTISSA) - 1)
    out.reshape(-1)[cell[least]] = (zeros << MANTISSA) + mantissa.astype(np.int64) + 1
    return out


def sketches(docs: DataFrame, size: int) -> DataFrame:
    """``doc, at, n, digest, registers``: of the set of each text; no digest for an empty one. ``at`` is a hash of the text."""
    import xxhash

    def work(batch) -> dict:
        texts = texts_of(batch)
        hashes, owner = shingle_hashes(texts, size)
        n = np.bincount(owner, minlength=len(texts))
        ends = np.cumsum(n)
        digests = [
            xxhash.xxh3_128_digest(hashes[z - k : z].tobytes()) if k else None for k, z in zip(n.tolist(), ends.tolist())
        ]
        flat = pa.array(registers(hashes, owner, len(texts)).reshape(-1))
        lists = pa.ListArray.from_arrays(np.arange(len(texts) + 1, dtype=np.int32) * REGISTERS, flat)
        return {"doc": batch.column("doc"), "at": batch.column("at"), "n": n, "digest": digests, "registers": lists}

    fields = "at bigint, n bigint, digest binary, registers array<int>"
    schema = T.StructType([docs.schema["doc"], *T.StructType.fromDDL(fields).fields])
    return each_batch(docs, work, schema)


def full_sets(docs: DataFrame, wanted: DataFrame, size: int) -> DataFrame:
    """``node, set``: sorted hashes of the wanted nodes, read again from the document that stands for each."""

    def work(batch) -> dict:
        texts = texts_of(batch)
        hashes, owner = shingle_hashes(texts, size)
        offsets = np.concatenate([[0], np.cumsum(np.bincount(owner, minlength=len(texts)))]).astype(np.int32)
        return {"node": batch.column("node"), "set": pa.ListArray.from_arrays(offsets, pa.array(hashes.view(np.int64)))}

    keyed = docs.withColumn("id", comparable_id("doc"))
    found = keyed.join(wanted.select("id", "at", "node"), ["id", "at"]).select("node", "text")
    # A repeated row stands for its node as often as it is there.
    return each_batch(found, work, "node bigint, set array<bigint>").groupBy("node").agg(F.any_value("set").alias("set"))


def collision_chance(n_a: Column, n_b: Column) -> Column:
    """Chance that two sets of such sizes without a common element agree in a register.

    A bucket holds n / 128 hashes on average; its smallest, as a share x of the range, has the density r * exp(-r * x).
    With z leading zeros, x lies between 2**-(z + 1) and 2**-z, in cells that are 2**MANTISSA times narrower.
    """
    a, b = n_a / REGISTERS, n_b / REGISTERS
    terms = [
        (F.exp(-(a + b) * 2.0 ** -(z + 1)) - F.exp(-(a + b) * 2.0**-z)) * 2.0 ** -(z + 1 + MANTISSA) for z in range(40)
    ]
    return sum(terms[1:], terms[0]) * a * b / (a + b)


def likely(percent: int) -> Column:
    """Whether the registers of a pair (n_a, n_b, r_a, r_b) leave room for the similarity."""
    both = F.zip_with("r_a", "r_b", lambda x, y: F.when((x == 0) & (y == 0), 0).when(x == y, 1001).otherwise(1))
    total = F.aggregate(both, F.lit(0), lambda s, x: s + x)
    filled, equal = total % 1000, F.floor(total / 1000)
    estimate = (equal - F.lit(REGISTERS) * collision_chance(F.col("n_a"), F.col("n_b"))) / filled
    share = percent / 100
    return estimate >= share - DEVIATIONS * math.sqrt(share * (1 - share)) / F.sqrt(filled)


def sizes_allow(a: Column, b: Column, percent: int) -> Column:
    return F.least(a, b) * 100 >= F.greatest(a, b) * percent


def verified(pairs: DataFrame, nodes: DataFrame, sets: DataFrame, percent: int) -> DataFrame:
    """The pairs ``a, b`` of nodes whose full sets are similar enough."""
    side = nodes.select("node", "n", "registers")
    known = pairs.join(side.toDF("a", "n_a", "r_a"), "a").join(side.toDF("b", "n_b", "r_b"), "b")
    few = known.filter(sizes_allow(F.col("n_a"), F.col("n_b"), percent)).filter(likely(percent)).select("a", "b")
    full = few.join(sets.toDF("a", "s_a"), "a").join(sets.toDF("b", "s_b"), "b")
    common = F.size(F.array_intersect("s_a", "s_b"))
    union = F.size("s_a") + F.size("s_b") - common
    return full.filter(common.cast("bigint") * 100 >= union.cast("bigint") * percent).select("a", "b")


def meetings(nodes: DataFrame) -> DataFrame:
    """``key, node, n, met``: nodes by band, where more than one node agrees in it."""
    keys = []
    for band in range(BANDS):
        own = [F.col("registers")[band * ROWS + r] for r in range(ROWS)]
        filled = sum(own[1:], own[0]) > 0
        keys.append(F.when(filled, F.xxhash64(F.lit(band), *own)))
    each = nodes.select("node", "n", F.explode(F.array(*keys)).alias("key")).filter("key IS NOT NULL")
    counts = each.groupBy("key").agg(F.count(F.lit(1)).alias("met")).filter("met > 1")
    return each.join(counts, "key")


def crossings(members: DataFrame, sets: DataFrame, percent: int) -> DataFrame:
    """Pairs of nodes of different components whose sets may be similar enough; none that are is left out.

    ``members``: ``node, n, component``. Put the shingles of a set in any order that is the same for all sets; then two
    similar sets share one of their first n - ceil(n * percent / 100) + 1. Here those that one component alone holds come
    first: they join nothing, and a node with enough of them has no partner at all. The others follow, rarest
    first, so that a line which very many documents share stands at the end of every order. Where two sets meet first,
    what stands behind in either order bounds their intersection.
    """
    own = sets.join(members.select("node", "component"), "node")
    each = own.select("node", "component", F.explode("set").alias("shingle"))
    counts = each.groupBy("shingle").agg(
        F.count(F.lit(1)).alias("held"), F.min("component").alias("_l"), F.max("component").alias("_h")
    )
    several = counts.filter("_l < _h").select("shingle", "held")
    listed = (
        each.select("node", "shingle")
        .join(several, "shingle")
        .groupBy("node")
        .agg(F.sort_array(F.collect_list(F.struct("held", "shingle"))).alias("order"))
        .join(members, "node")
    )
    first = F.expr(f"cast(n - (n * {percent} + 99) div 100 + 1 - (n - size(order)) as int)")
    ahead = listed.withColumn("first", first).filter("first > 0")
    ahead = ahead.select(
        "node", "n", "component", F.size("order").alias("m"), F.posexplode(F.slice("order", F.lit(1), F.col("first"))).alias("at", "s")
    )
    columns = ("node", "n", "component", "left")
    left = (F.col("m") - F.col("at")).cast("bigint").alias("left")
    ahead = stored(ahead.select("node", "n", "component", left, F.col("s.shingle").alias("shingle")), "minhash-ahead")
    met = ahead.groupBy("shingle").agg(
        F.count(F.lit(1)).alias("met"), F.min("component").alias("_l"), F.max("component").alias("_h")
    )
    met = ahead.join(met.filter("_l < _h").select("shingle", "met"), "shingle")
    blocks = F.ceil(F.col("met") / BLOCK).cast("int")
    cut = met.withColumns({"blocks": blocks, "own": F.pmod(F.xxhash64("node"), blocks).cast("int")})
    other = F.explode(F.sequence(F.lit(0), F.col("blocks") - 1)).alias("other")
    x = cut.select("shingle", *columns, "own", other).toDF("shingle", "a", "n_a", "c_a", "l_a", "i", "j")
    y = cut.select("shingle", *columns, "own", other).toDF("shingle", "b", "n_b", "c_b", "l_b", "j", "i")
    common = F.least("l_a", "l_b")
    enough = common * 100 >= (F.col("n_a") + F.col("n_b") - common) * percent
    return x.join(y, ["shingle", "i", "j"]).filter((F.col("c_a") < F.col("c_b")) & enough).select("a", "b").distinct()


def near_duplicates(
    docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", size: int = SHINGLE, percent: int = PERCENT
) -> DataFrame:
    """One row per document: ``id, n_shingles, component_id, kept``.

    Words are lower-cased (A-Z) and stand between ASCII white space; a document's set are its shingles of ``size`` words,
    or all its words if it has fewer. Two documents are linked if 100 * intersection >= percent * union;
    ``component_id`` is the smallest id that a document reaches, ``kept`` whether that is its own.

    Null, empty or blank text: an empty set, linked with nothing, its own component. Null id: larger than every other; a
    component of null ids alone is null, and all its documents are kept. Repeated rows: one row each, and as one id all
    kept. Shingles are compared by 64-bit hashes, sets of equal documents by 128 bits. A similar pair fails to meet with
    a chance of 5 in 10**8, and fails the estimate with 1 in 10**6. Empty input: no rows.
    """
    prepared(docs.sparkSession)
    texts = docs.select(F.col(id_col).alias("doc"), F.col(text_col).alias("text"))
    found = stored(sketches(texts.withColumn("at", F.xxhash64("text")), size), "minhash-sketches")
    distinct = (
        found.filter("digest IS NOT NULL")
        .groupBy("digest")
        .agg(
            F.min(F.struct(comparable_id("doc").alias("id"), "at")).alias("first"),
            F.any_value("n").alias("n"),
            F.any_value("registers").alias("registers"),
        )
        .select("digest", "first.id", "first.at", "n", "registers", F.monotonically_increasing_id().alias("node"))
    )
    nodes = stored(distinct, "minhash-nodes")
    # Different sets of fewer than this many cannot be similar enough.
    least = math.ceil(percent / (100 - percent)) if percent < 100 else LARGEST
    met = stored(meetings(nodes.filter(F.col("n") >= least)), "minhash-meetings")
    fame = met.groupBy("node").agg(F.sum("met").alias("fame"))
    hub = met.join(fame, "node").groupBy("key").agg(F.max(F.struct("fame", "node"))["node"].alias("hub"))
    around = met.join(hub, "key").filter("node != hub")
    wanted = nodes.join(met.select("node").distinct(), "node", "left_semi")
    sets = stored(full_sets(texts.withColumn("at", F.xxhash64("text")), wanted, size), "minhash-sets")
    stars = stored(
        verified(around.select(F.col("node").alias("a"), F.col("hub").alias("b")).distinct(), nodes, sets, percent),
        "minhash-stars",
    )
    near = components(stars)
    labelled = met.select("key", "node", "n").join(near, "node", "left")
    labelled = stored(labelled.withColumn("component", F.coalesce("component", "node")), "minhash-labelled")
    several = labelled.groupBy("key").agg(F.min("component").alias("_l"), F.max("component").alias("_h"))
    rest = labelled.join(several.filter("_l < _h").select("key"), "key", "left_semi")
    more = verified(crossings(rest.select("node", "n", "component").distinct(), sets, percent), nodes, sets, percent)
    linked = components(stars.unionByName(stored(more, "minhash-crossings")))
    member = nodes.select("digest", "node", "id").join(linked, "node", "left")
    member = member.withColumn("component", F.coalesce("component", "node"))
    least_id = member.groupBy("component").agg(F.min("id").alias("component_id"))
    known = member.join(least_id, "component").select("digest", "component_id")
    own = F.when(F.col("digest").isNull(), comparable_id("doc")).otherwise(F.col("component_id"))
    out = found.select("doc", "n", "digest").join(known, "digest", "left").select(
        F.col("doc").alias(id_col), F.col("n").alias("n_shingles"), F.when(own != LARGEST, own).alias("component_id")
    )
    return out.withColumn("kept", F.col(id_col).cast("bigint").eqNullSafe(F.col("component_id")))


# For a few thousand documents: every two that share a shingle are compared.
SQL = r"""
WITH RECURSIVE words AS (
    SELECT doc_id, regexp_extract_all(
        translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x20\x09-\x0D]+') AS w
    FROM documents
), sets AS (
    SELECT doc_id, CASE WHEN len(w) = 0 THEN [] WHEN len(w) < 4 THEN [array_to_string(w, ' ')]
        ELSE list_distinct(list_transform(range(1, len(w) - 2), lambda i: array_to_string(w[i:i + 3], ' '))) END AS s
    FROM words
), sizes AS (
    SELECT doc_id, len(s) AS n, s FROM sets
), shingles AS (
    SELECT doc_id, n, md5(unnest(s)) AS x FROM sizes
), links AS (
    SELECT a.doc_id AS a, b.doc_id AS b FROM shingles a JOIN shingles b ON a.x = b.x AND a.doc_id <> b.doc_id
    AND 5 * least(a.n, b.n) >= 4 * greatest(a.n, b.n)
    GROUP BY a.doc_id, b.doc_id, a.n, b.n HAVING 100 * count(*) >= 80 * (a.n + b.n - count(*))
), reached AS (
    SELECT doc_id AS a, doc_id AS b FROM documents
    UNION SELECT r.a, l.b FROM reached r JOIN links l ON l.a = r.b
)
SELECT doc_id, n AS n_shingles, least(doc_id, min(b)) AS component_id, doc_id = min(b) AS kept
FROM sizes JOIN reached ON a = doc_id GROUP BY doc_id, n
"""
