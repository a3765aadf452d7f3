"""SimHash near-duplicate classes by anchor-point covering.

A 64-bit fingerprint is cut into two blocks of 31 bits (two bits are left over). Fingerprints that
differ in at most three bits differ in at most one bit of at least one block. For a block the
anchors are the codewords of the perfect Hamming code (31, 26): it covers the space with radius
one, so each block value has exactly one nearest anchor. A fingerprint goes as core to its nearest
anchor, and as guest to every anchor within two (radius one plus the block's threshold one): one
anchor if it is a codeword, else 16. A core and a guest meet at an anchor whenever their blocks
differ in one bit or less, so no link is lost; the whole fingerprints are compared there.

Fingerprints are compared once each, however many documents have them. The comparison is an
equi-join on (block, anchor) with a filter: it spills, and adaptive execution splits a hot anchor.
"""

from __future__ import annotations

import re
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tidewright.llm import common

BLOCK, SPACE = 1 << 20, re.compile(rb"[\t-\r ]")  # bytes split into words at once, about
BITS = 31  # of a block: 2**5 - 1, the length of the Hamming code with five check bits
LAST = 2**63 - 1
TOGETHER = 100_000  # edges whose components one task finds; more go in rounds over all tasks


def hashes(text: str, size: int, seed: int) -> Iterator[np.ndarray]:
    """The hashes of all word shingles, repeats included, in parts; a text of fewer words is one shingle, one of none has none.

    Words are what ASCII white space separates, after A-Z are lower-cased. A long text is split by blocks,
    each with the words before it that its first shingles need.
    """
    raw = text.encode("utf-8", "surrogatepass").lower()
    h64, before, short, at = xxhash.xxh64_intdigest, [], True, 0
    while at < len(raw):
        end = SPACE.search(raw, at + BLOCK) if len(raw) - at > BLOCK else None
        end = end.start() if end else len(raw)
        words = before + raw[at:end].split()
        at = end
        if len(words) >= size:
            joined = b" ".join(words)
            lengths = np.fromiter(map(len, words), np.int64, len(words))
            ends = np.cumsum(lengths + 1) - 1
            starts = (ends - lengths)[: len(words) - size + 1].tolist()
            yield np.array([h64(joined[a:b], seed) for a, b in zip(starts, ends[size - 1 :].tolist(), strict=True)], np.uint64)
            short = False
        before = words[len(words) - size + 1 :] if size > 1 and len(words) >= size else [] if size == 1 else words
    if short and before:
        yield np.array([h64(b" ".join(before), seed)], np.uint64)


def fingerprint(text: str, size: int = 3, seed: int = 42) -> int:
    """The majority bits of the hashes of all word shingles, repeats included; no word: zero."""
    ones, n = np.zeros(64, np.int64), 0
    for own in hashes(text, size, seed):
        octets = own.astype(">u8").view(np.uint8).reshape(-1, 8)
        n += len(own)
        for at in range(0, len(octets), 1 << 16):
            ones += np.unpackbits(octets[at : at + (1 << 16)], axis=1).sum(0, dtype=np.int64)
    return int.from_bytes(np.packbits(2 * ones > n).tobytes(), "big")


def fingerprints(documents: DataFrame, size: int = 3, seed: int = 42) -> DataFrame:
    """doc_id, fp (the fingerprint as a signed long) of every whole text; null counts as empty."""

    def each(batch: pa.RecordBatch) -> pa.RecordBatch:
        fps = np.array([fingerprint(t, size, seed) for t in common.texts_of(batch.column(1))], np.uint64)
        return pa.record_batch([batch.column(0), pa.array(fps.view(np.int64))], ["doc_id", "fp"])

    source = common.pick(documents, "doc_id", "text").select(F.col("doc_id").cast("long").alias("doc_id"), "text")
    return common.map_arrow(source, each, "doc_id long, fp long")


def _block(fp: Column, at: int) -> Column:
    return F.shiftrightunsigned(fp, BITS * at).bitwiseAND(F.lit(2**BITS - 1))


def _syndrome(block: Column) -> Column:
    """The xor of the positions (1 to 31) of the block's ones: zero for a codeword."""
    out = F.lit(0)
    for j in range(5):
        mask = sum(1 << (i - 1) for i in range(1, BITS + 1) if i >> j & 1)
        out = out + F.shiftleft(F.bit_count(block.bitwiseAND(F.lit(mask).cast("long"))) % 2, j)
    return out


def _flip(block: Column, position: Column) -> Column:
    return F.when(position > 0, block.bitwiseXOR(F.call_function("shiftleft", F.lit(1).cast("long"), position - 1))).otherwise(block)


def anchored(classes: DataFrame, guests: bool) -> DataFrame:
    """A row (block, anchor, fp, rep) for the nearest anchor of each block, or for all within two."""
    parts = []
    for at in (0, 1):
        one = classes.withColumn("x", _block(F.col("fp"), at)).withColumn("s", _syndrome(F.col("x")))
        anchors = F.array(_flip(F.col("x"), F.col("s")))
        if guests:  # two flips reach a codeword when their positions' xor is the syndrome
            pairs = F.filter(F.sequence(F.lit(1), F.lit(BITS)), lambda i: (F.col("s") > 0) & (i != F.col("s")) & (i < i.bitwiseXOR(F.col("s"))))
            anchors = F.concat(anchors, F.transform(pairs, lambda i: _flip(_flip(F.col("x"), i), i.bitwiseXOR(F.col("s")))))
        parts.append(one.select(F.lit(at).alias("block"), F.explode(anchors).alias("anchor"), "fp", "rep"))
    return parts[0].unionByName(parts[1])


def links(classes: DataFrame, threshold: int = 3) -> DataFrame:
    """Pairs (u, v), u > v, of the representatives of fingerprints within the threshold (3 at most).

    Two blocks bring one at most one differing bit for up to three of them in all.
    """
    if not 0 <= threshold <= 3:
        raise ValueError("two blocks of radius one cover thresholds from 0 to 3")
    core, guest = anchored(classes, False).alias("a"), anchored(classes, True).alias("b")
    near = (F.col("a.block") == F.col("b.block")) & (F.col("a.anchor") == F.col("b.anchor")) & (F.bit_count(F.col("a.fp").bitwiseXOR(F.col("b.fp"))) <= threshold) & (F.col("a.fp") != F.col("b.fp"))
    return core.join(guest, near).select(F.greatest("a.rep", "b.rep").alias("u"), F.least("a.rep", "b.rep").alias("v")).distinct()


def _joined(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """components() of all edges at once, by union and find."""
    parent: dict[int, int] = {}

    def find(a: int) -> int:
        while (b := parent.setdefault(a, a)) != a:
            parent[a] = a = parent[b] if b in parent else b
        return a

    for batch in batches:
        for u, v in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), strict=True):
            a, b = find(u), find(v)
            if a != b:
                parent[max(a, b)] = min(a, b)
    pairs = [(u, r) for u in list(parent) if (r := find(u)) != u]
    yield pa.record_batch([pa.array([p[i] for p in pairs], pa.int64()) for i in (0, 1)], ["u", "root"])


def _state(edges: DataFrame) -> tuple:
    return tuple(edges.agg(F.count("*"), F.sum(F.xxhash64("u", "v").cast("decimal(38,0)"))).first())


def components(edges: DataFrame) -> DataFrame:
    """(u, root): for every vertex of an edge its component's least vertex, if that is another one.

    Edges that have been counted to be few (TOGETHER) are joined in one task. More of them alternate large-star and
    small-star rounds; each ends in a checkpoint, so lineage stays short and a lost executor costs one round. Only aggregates and joins on the vertex: no neighbourhood is ever
    gathered in one row.
    """
    edges = common.durable(edges)
    if edges.limit(TOGETHER + 1).count() <= TOGETHER:
        return edges.select("u", "v").coalesce(1).mapInArrow(_joined, "u long, root long")
    before = _state(edges)
    while True:
        both = edges.unionByName(edges.select(F.col("v").alias("u"), F.col("u").alias("v")))
        least = both.groupBy("u").agg(F.least(F.col("u"), F.min("v")).alias("m"))
        large = both.filter("v > u").join(least, "u").select(F.col("v").alias("u"), F.col("m").alias("v")).distinct()
        least = large.groupBy("u").agg(F.min("v").alias("m"))
        small = large.join(least, "u").select("u", "v", "m")
        small = small.filter("v != m").select(F.col("v").alias("u"), F.col("m").alias("v")).unionByName(least.select("u", F.col("m").alias("v")))
        edges = common.durable(small.distinct())
        after = _state(edges)
        if after == before:
            return edges.groupBy("u").agg(F.min("v").alias("root"))
        before = after


def near_duplicates(documents: DataFrame, size: int = 3, seed: int = 42, threshold: int = 3) -> DataFrame:
    """doc_id, fingerprint (16 lowercase hex digits), component_id of every document.

    component_id is the least doc_id that links lead to, the document's own included. Null and
    empty texts have the fingerprint zero and link like others; very long ones are read as a whole. Repeated rows stay repeated; extra
    columns are ignored; an empty table gives no rows. A null
    doc_id counts as larger than any other; a component of such rows alone has a null component_id.
    """
    rows = common.durable(fingerprints(documents, size, seed))
    # a fingerprint is the vertex of its class, as doc_ids may be null or shared
    classes = rows.groupBy("fp").agg(F.min(F.coalesce("doc_id", F.lit(LAST))).alias("first"))
    # a doc_id on rows with different texts joins their classes, as each has it as a document
    split = rows.filter("doc_id is not null").groupBy("doc_id").agg(F.min("fp").alias("v"), F.max("fp").alias("most")).filter("v != most").select("doc_id", "v")
    shared = rows.join(split, "doc_id").filter("fp != v").select(F.col("fp").alias("u"), "v")
    edges = links(classes.select("fp", F.col("fp").alias("rep")), threshold).unionByName(shared)
    roots = components(edges.distinct())
    labelled = classes.join(roots, classes["fp"] == roots["u"], "left").select("fp", "first", F.coalesce("root", "fp").alias("root"))
    least = labelled.groupBy("root").agg(F.min("first").alias("component_id"))
    return rows.join(labelled.join(least, "root").select("fp", "component_id"), "fp").select(
        "doc_id", F.lpad(F.lower(F.hex("fp")), 16, "0").alias("fingerprint"), F.nullif(F.col("component_id"), F.lit(LAST)).alias("component_id")
    )


BANDS, DEPTH = 40, 5  # a pair with similarity 0.8 shares no band with probability (1 - 0.8**5)**40, about 1.2e-7


def _shingles(text: str, size: int, seed: int) -> np.ndarray:
    """The distinct hashes of the word shingles; no word is the empty shingle."""
    out = np.zeros(0, np.uint64)
    for own in hashes(text, size, seed):
        out = np.unique(np.concatenate([out, own]))
    return out if len(out) else np.array([xxhash.xxh64_intdigest(b"", seed)], np.uint64)


def _class_of(text: str) -> int:
    """What texts of the same words share."""
    words = b" ".join(text.encode("utf-8", "surrogatepass").lower().split())
    return int(np.uint64(xxhash.xxh64_intdigest(words, 7)).astype(np.int64))


def _bands(shingles: np.ndarray, seed: int) -> list[int]:
    """A hash for each band of DEPTH least permuted hashes."""
    a, b = np.random.default_rng(seed).integers(0, 2**64, (2, BANDS * DEPTH, 1), np.uint64)
    a |= np.uint64(1)
    least = np.full(BANDS * DEPTH, 2**64 - 1, np.uint64)
    for at in range(0, len(shingles), 1 << 10):  # bounded, however long the text
        np.minimum(least, (shingles[at : at + (1 << 10)] * a + b).min(1), out=least)
    out = [xxhash.xxh64_intdigest(row.tobytes(), k) for k, row in enumerate(least.reshape(BANDS, DEPTH))]
    return np.array(out, np.uint64).view(np.int64).tolist()


def _keyed(documents: DataFrame) -> DataFrame:
    """(id, h, text) of every row: its doc_id (LAST: none) and a hash of its text, which name it in the smaller tables."""
    text = F.coalesce("text", F.lit(""))
    return common.pick(documents, "doc_id", "text").select(F.coalesce(F.col("doc_id").cast("long"), F.lit(LAST)).alias("id"), F.xxhash64(text).alias("h"), text.alias("text"))


def _classes(documents: DataFrame, size: int, seed: int) -> DataFrame:
    """(id, h, cls, n, fp, bands) of every row: what its words are known by, the number of its shingles, its fingerprint, its bands."""

    def each(batch: pa.RecordBatch) -> pa.RecordBatch:
        known: dict[int, tuple[int, int, list[int]]] = {}
        cls = []
        for text in common.texts_of(batch.column(2)):
            cls.append(_class_of(text))
            if cls[-1] not in known:
                s = _shingles(text, size, seed)
                known[cls[-1]] = len(s), int(np.uint64(fingerprint(text, size, seed)).astype(np.int64)), _bands(s, seed)
        found = [known[c] for c in cls]
        own = [batch.column(0), batch.column(1), pa.array(cls, pa.int64()), *[pa.array([f[i] for f in found], pa.int64()) for i in (0, 1)], pa.array([f[2] for f in found], pa.list_(pa.int64()))]
        return pa.record_batch(own, ["id", "h", "cls", "n", "fp", "bands"])

    return common.map_arrow(_keyed(documents), each, "id long, h long, cls long, n long, fp long, bands array<long>")


def _shingle_sets(documents: DataFrame, firsts: DataFrame, size: int, seed: int) -> DataFrame:
    """(cls, shingles) of the classes in firsts (id, h, cls), each from its first row."""

    def each(batch: pa.RecordBatch) -> pa.RecordBatch:
        texts = common.texts_of(batch.column(0))
        sets = [_shingles(t, size, seed).view(np.int64) for t in texts]
        return pa.record_batch([pa.array([_class_of(t) for t in texts], pa.int64()), pa.array(sets, pa.list_(pa.int64()))], ["cls", "shingles"])

    own = common.members(_keyed(documents), firsts.select("id", "h"), ["id", "h"], "left_semi")
    return common.map_arrow(own.select("text"), each, "cls long, shingles array<long>").groupBy("cls").agg(F.first("shingles").alias("shingles"))


def _confirmed(pairs: DataFrame, sets: DataFrame, least: int) -> DataFrame:
    """The pairs (u, v) whose shingle sets have a Jaccard similarity of least permille or more."""
    both = pairs.join(sets.select(F.col("cls").alias("u"), F.col("shingles").alias("x")), "u").join(sets.select(F.col("cls").alias("v"), F.col("shingles").alias("y")), "v")
    shared = F.size(F.array_intersect("x", "y"))
    return both.filter(shared * 1000 >= least * (F.size("x") + F.size("y") - shared)).select("u", "v")


def _overlap(a: Column, b: Column, least: int) -> Column:
    """Shingles that sets of these sizes share at least if their similarity is least permille."""
    return _ceil((a + b) * least, 1000 + least)


def _ceil(a: Column, b: int) -> Column:
    """a / b rounded up, in whole numbers."""
    return F.call_function("div", a + (b - 1), F.lit(b).cast("long"))


def _prefixes(sets: DataFrame, least: int) -> DataFrame:
    """(cls, part, n, t, pos): of each set the shingles, rarest first, that at least one must be shared of with any set as similar.

    Shingles of one set alone come first and have no row; a set with enough of them is similar to no other.
    """
    tokens = sets.select("cls", "part", F.size("shingles").cast("long").alias("n"), F.explode("shingles").alias("t"))
    freq = common.durable(tokens.groupBy("t").agg(F.count("*").alias("df"), F.min("cls").alias("only")))
    alone = freq.filter("df = 1").groupBy(F.col("only").alias("cls")).agg(F.count("*").alias("alone"))
    reach = F.col("n") - _ceil(F.col("n") * least, 1000) + 1
    open_ = tokens.join(alone, "cls", "left").withColumn("alone", F.coalesce("alone", F.lit(0).cast("long"))).filter(F.col("alone") < reach)
    common_ = open_.join(freq.filter("df > 1").select("t", "df"), "t")
    pos = F.col("alone") + F.row_number().over(Window.partitionBy("cls").orderBy("df", "t")) - 1
    return common_.withColumn("pos", pos).filter(F.col("pos") < reach).select("cls", "part", "n", "t", "pos")


def _unjoined(prefixes: DataFrame, least: int) -> DataFrame:
    """Pairs (u, v) of sets of different parts whose prefixes allow them to be similar; prefixes have part.

    At each shingle the sets outside its most frequent part meet all of its sets: two of one part need no comparison, so that a group of copies,
    however large, meets only those that aren't in it.
    """
    parts = prefixes.groupBy("t", "part").agg(F.count("*").alias("m"))
    main = parts.groupBy("t").agg(F.max_by("part", F.struct("m", "part")).alias("main"), F.count("*").alias("k")).filter("k > 1").select("t", "main")
    held = common.durable(prefixes.join(main, "t"))
    a, b = held.filter("part != main").alias("a"), held.alias("b")
    once = (F.col("b.part") == F.col("b.main")) | (F.col("a.cls") > F.col("b.cls"))
    shared = _overlap(F.col("a.n"), F.col("b.n"), least)
    near = (F.col("a.t") == F.col("b.t")) & (F.col("a.part") != F.col("b.part")) & once & (F.col("a.pos") <= F.col("a.n") - shared) & (F.col("b.pos") <= F.col("b.n") - shared)
    near &= F.least("a.n", "b.n") * 1000 >= F.greatest("a.n", "b.n") * least
    return a.join(b, near).select(F.greatest("a.cls", "b.cls").alias("u"), F.least("a.cls", "b.cls").alias("v")).distinct()


def _covered(classes: DataFrame) -> DataFrame:
    """Pairs (u, v), u > v, of classes (cls, fp) that the covering links: each with the least one of its fingerprint, those with one another by links()."""
    least = classes.groupBy("fp").agg(F.min("cls").alias("rep"))
    same = classes.join(least, "fp").filter("cls != rep").select(F.col("cls").alias("u"), F.col("rep").alias("v"))
    return links(least).unionByName(same)


def similar_classes(rows: DataFrame, documents: DataFrame, size: int = 5, seed: int = 42, least: int = 800) -> DataFrame:
    """(cls, first, root): for every distinct text of rows, the _classes() of documents, its first row and the root of its near-duplicate group.

    Texts are linked where their sets of word shingles have a Jaccard similarity of least permille or more. Those whose fingerprints meet in the
    covering (links()) are looked at first, then, as fingerprints of texts as similar differ in up to some 14 bits and the covering reaches
    three, those that share a band of MinHash. Whole sets decide of both. In each bucket all are compared, by whole sets, with the member that has the least share of rare shingles, which is
    the one that most copies come from: that joins nearly every group. Then texts of buckets that hold several groups still are compared
    wherever the rarest shingles of their sets allow a similarity as great (a prefix filter, which loses none).
    """
    first = F.min(F.struct("id", "h")).alias("first")
    classes = common.durable(rows.groupBy("cls").agg(first, F.any_value("n").alias("n"), F.any_value("fp").alias("fp"), F.any_value("bands").alias("bands")))
    covered = common.durable(_covered(classes))
    members = classes.select("cls", "n", F.explode("bands").alias("key"))
    groups = members.groupBy("key").agg(F.min("cls").alias("low"), F.max("cls").alias("high")).filter("low < high").select("key")
    crowded = common.durable(members.join(groups, "key"))
    met = covered.select(F.explode(F.array("u", "v")).alias("cls")).unionByName(crowded.select("cls")).distinct()
    firsts = classes.join(met, "cls", "left_semi").select("first.id", "first.h")
    sets = common.durable(_shingle_sets(documents, firsts, size, seed))
    # an eighth of all shingles, the same ones of every set, tells which members hold few that others lack
    some = sets.select("cls", F.explode(F.filter("shingles", lambda t: t.bitwiseAND(F.lit(7).cast("long")) == 0)).alias("t"))
    freq = some.groupBy("t").agg(F.count("*").alias("df"), F.min("cls").alias("low"), F.max("cls").alias("high")).filter("df <= 2")
    rare = freq.select(F.explode(F.array_distinct(F.array("low", "high"))).alias("cls")).groupBy("cls").agg(F.count("*").alias("rare"))
    apart = F.struct((F.coalesce("rare", F.lit(0)) / F.col("n")).alias("share"), "cls", "n")
    placed = common.durable(crowded.join(rare, "cls", "left").select("key", "cls", "n", apart.alias("apart")))
    pivots = placed.groupBy("key").agg(F.min("apart").alias("p")).select("key", F.col("p.cls").alias("pivot"), F.col("p.n").alias("pivot_n"))
    fit = F.least("n", "pivot_n") * 1000 >= F.greatest("n", "pivot_n") * least  # else their similarity is less
    star = placed.join(pivots, "key").filter((F.col("cls") != F.col("pivot")) & fit).select(F.col("cls").alias("u"), F.col("pivot").alias("v")).distinct()
    # of each class one link of the covering; those that then still lead from one group to another are looked at below
    nearest = covered.groupBy("u").agg(F.min("v").alias("v"))
    edges = common.durable(_confirmed(nearest.unionByName(star).distinct(), sets, least))
    found = common.durable(components(edges))
    root = lambda side: found.select(F.col("u").alias(side), F.col("root").alias(f"{side}_root"))
    across = covered.join(root("u"), "u", "left").join(root("v"), "v", "left").filter(F.coalesce("u_root", "u") != F.coalesce("v_root", "v")).select("u", "v")
    parts = placed.select("key", "cls").join(found, placed["cls"] == found["u"], "left").select("key", "cls", F.coalesce("root", "cls").alias("part"))
    mixed = parts.groupBy("key").agg(F.min("part").alias("low"), F.max("part").alias("high")).filter("low < high").select("key")
    rest = common.durable(parts.join(mixed, "key").select("cls", "part").distinct())
    others = common.durable(_unjoined(_prefixes(sets.join(rest, "cls"), least), least))
    roots = components(edges.unionByName(_confirmed(others.unionByName(across).distinct(), sets, least)))
    return classes.join(roots, classes["cls"] == roots["u"], "left").select("cls", "first", F.coalesce("root", "cls").alias("root"))


def keep_one(documents: DataFrame, size: int = 5, seed: int = 42, least: int = 800) -> DataFrame:
    """The documents, one of each near-duplicate group of similar_classes(): that with the least doc_id.

    All columns stay. Of rows that repeat the kept doc_id and text one stays. A null doc_id counts as
    larger than any other; null and empty texts are one group; very long ones are compared as a whole. An empty table stays empty. The decisions are made on ids and hashes; texts aren't shuffled
    while the rows that go, or that repeat, are few (common.FEW).
    """
    rows = common.durable(_classes(documents, size, seed))
    kept = similar_classes(rows, documents, size, seed, least).groupBy("root").agg(F.min(F.struct("first.id", "cls", "first.h")).alias("k")).select("k.id", "k.h")
    kept = common.durable(kept)
    named = rows.groupBy("id", "h").agg(F.count("*").alias("times"))
    gone = common.durable(named.join(kept, ["id", "h"], "left_anti").select("id", "h"))
    again = common.durable(named.filter("times > 1").join(kept, ["id", "h"], "left_semi").select("id", "h"))
    plain, at = common.numbered(documents)
    own = plain.withColumn("id", F.coalesce(F.col(at["doc_id"]).cast("long"), F.lit(LAST))).withColumn("h", F.xxhash64(F.coalesce(at["text"], F.lit(""))))
    left = common.members(own, gone, ["id", "h"], "left_anti")
    if not again.isEmpty():
        left = common.members(left, again, ["id", "h"], "left_anti").unionByName(common.members(left, again, ["id", "h"], "left_semi").dropDuplicates(["id", "h"]))
    return left.select(*plain.columns).toDF(*documents.columns)
