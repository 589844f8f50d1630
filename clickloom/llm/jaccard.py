"""Jaccard join of documents on word n-grams, and its groups.

Sets meet in *tiles*: a tile is a band of sizes and one part of the space of shingle hashes, with the
hash of what a set has in that part. Sets that are similar enough differ in fewer shingles than there
are parts, so one part at least is equal, and they share a tile. In a tile, bitmaps of hashed shingles
bound the intersection from above before sorted arrays of shingles are intersected.

A tile of many near copies is not compared all with all. First every set is compared with the smallest
document of its tiles, which connects nearly all of them. Only sets that are then not connected with
most of their tiles are compared with the others, in blocks.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from clickloom.llm import arrays as A
from clickloom.llm.bitmap import bitmap_of, passes
from clickloom.llm.graph import components
from clickloom.llm.repeats import by_bucket
from clickloom.llm.shared import buckets_for, staged

#: Tile entries that a task gathers before it sends them on.
GATHER = 300_000
#: Bytes of text in one step: a word becomes a tile in each of two or three bands.
STEP_BYTES = 1 << 20
#: Sets of either side that meet in one task; larger groups are cut into blocks.
BLOCK = 512
#: Bits of the bitmap of documents whose texts are read again (2 MiB).
WANTED_BITS = 1 << 24
#: At least so many parts more than similar sets may differ in: as many may be empty.
SLACK = 2


def _bands() -> np.ndarray:
    bounds = [1]
    while bounds[-1] < 1 << 40:
        bounds.append(max(bounds[-1] + 1, bounds[-1] * 3 // 2))
    return np.array(bounds, np.int64)


BANDS = _bands()


def shingles(texts: A.Texts, words: int) -> tuple[np.ndarray, np.ndarray]:
    """Number of the text and hash of its distinct shingles, sorted. Fewer words than ``words`` are one shingle."""
    lowered = A.Texts(A.LOWER[texts.data], texts.offsets, texts.null)
    found = A.words_of(lowered, A.NOT_BLANK)
    hashes = A.hash_spans(lowered.data, found.start, found.end)
    count = found.counts()
    key = A.rolling(hashes, words)
    whole = np.flatnonzero(np.arange(len(key)) + words <= found.first[1:][found.text[: len(key)]])
    text, key = found.text[whole], key[whole]
    for n in range(1, words):
        few = np.flatnonzero(count == n)
        if len(few):
            text = np.concatenate((text, few))
            key = np.concatenate((key, A.mix(A.rolling(hashes, n)[found.first[few]] + A.U(n))))
    order = np.lexsort((key, text))
    text, key = text[order], key[order]
    new = np.ones(len(text), bool)
    new[1:] = (text[1:] != text[:-1]) | (key[1:] != key[:-1])
    return text[new], key[new]


Rows = tuple[np.ndarray, np.ndarray, np.ndarray]


def tile_keys(text: np.ndarray, key: np.ndarray, percent: int) -> tuple[Rows, Rows]:
    """Every tile that a set is in, and how many of its tiles it must share to have a partner at all.

    Both are given by the number of the text, the step from its own band of sizes to that of the
    partner, and the tile's key or the number.
    """
    edges = A.group_edges(text)
    size = np.diff(edges)
    none = np.zeros(0, np.int64)
    tiles, needs = [(none, none, np.zeros(0, np.uint64))], [(none, none, none)]
    own = np.searchsorted(BANDS, size, "right") - 1
    step = 0
    while True:
        # Partners of the own band and of those above with sets that are not too large.
        in_band = np.flatnonzero(BANDS[own + step] * percent <= 100 * size)
        if not len(in_band):
            return tuple(map(np.concatenate, zip(*tiles, strict=True))), tuple(map(np.concatenate, zip(*needs, strict=True)))
        band, n = own[in_band] + step, size[in_band]
        largest = BANDS[band + 1] - 1
        differ = (100 - percent) * 2 * largest // (100 + percent)
        # Half as many parts more: then similar sets share a good part of their tiles, and others do not.
        spare = np.maximum(SLACK, (differ + 1) // 2)
        parts = differ + 1 + spare
        members = np.repeat(in_band, n)
        at = np.arange(len(members)) - np.repeat(np.cumsum(n) - n, n) + edges[:-1][members]
        part = ((key[at] >> A.U(32)) * np.repeat(parts, n).astype(A.U) >> A.U(32)).astype(np.int64)
        where = A.group_edges(members, part)
        content = np.add.reduceat(A.mix(key[at] + A.U(0xA0761D6478BD642F)), where[:-1])
        who, part = members[where[:-1]], part[where[:-1]]
        salt = (own[who] + step).astype(A.U) << A.U(40) | part.astype(A.U)
        tiles.append((text[edges[:-1]][who], np.full(len(who), step), A.mix(content ^ A.mix(salt))))
        # Two sets may be equal in empty parts only if both have so many; then these count too.
        filled = np.bincount(who, minlength=len(size))[in_band]
        for i in np.flatnonzero(parts - filled > spare):
            empty = np.setdiff1d(np.arange(parts[i]), part[who == in_band[i]]).astype(A.U)
            tiles.append((np.full(len(empty), text[edges[in_band[i]]]), np.full(len(empty), step), A.mix(A.mix(A.U(band[i]) << A.U(40) | empty))))
        # A partner of this band differs in no more parts than this; all others are shared, or empty in both.
        partner = np.minimum(largest, 100 * n // percent)
        most = (100 - percent) * (n + partner) // (100 + percent)
        needs.append((text[edges[:-1]][in_band], np.full(len(n), step), np.maximum(1, filled - most)))
        step += 1


def bitmap(key: np.ndarray) -> np.ndarray:
    """A bit for each shingle, by its last bits; as many 64-bit words as a power of two for twice the shingles."""
    words = 1 << max(0, (2 * len(key) - 1).bit_length() - 6)
    out = np.zeros(words, np.uint64)
    bit = key & A.U(words * 64 - 1)
    np.bitwise_or.at(out, (bit >> A.U(6)).astype(np.int64), A.U(1) << (bit & A.U(63)))
    return out


def folded(bits: np.ndarray, words: int) -> np.ndarray:
    """The bitmap that the same shingles give with fewer words."""
    return np.bitwise_or.reduce(bits.reshape(-1, words), 0)


def linked(a: np.ndarray, a_bits: np.ndarray, b: np.ndarray, b_bits: np.ndarray, percent: int) -> bool:
    """Whether 100 times the intersection reaches ``percent`` times the union."""
    need = percent * (len(a) + len(b))  # of the intersection, times 100 + percent
    words = min(len(a_bits), len(b_bits))
    x, y = folded(a_bits, words), folded(b_bits, words)
    # A bit that only one set has stands for a shingle at least that the other lacks.
    most = min(len(a) - int(np.bitwise_count(x & ~y).sum()), len(b) - int(np.bitwise_count(y & ~x).sum()))
    if (100 + percent) * most < need:
        return False
    if len(a) > len(b):
        a, b = b, a
    at = np.searchsorted(b, a)
    at[at == len(b)] = 0
    return (100 + percent) * int((b[at] == a).sum()) >= need


#: Bits of a tile's key that are sent; its bucket tells more. Keys that agree by chance only cost a comparison.
KEY_BITS = 40

_SENT = "kind int, bucket int, payload binary, doc long, n long, d1 long, d2 long"
_MET = "kind int, key long, step long, doc long, n long, d1 long, d2 long"
_SETS = "doc long, bits binary, shingles binary"


def _send(words: int, percent: int, buckets: int):
    names = [f.split()[0] for f in _SENT.split(", ")]
    kinds = (pa.int32(), pa.int32(), pa.binary(), pa.int64(), pa.int64(), pa.int64(), pa.int64())

    def batch_of(rows: int, **columns) -> pa.RecordBatch:
        return pa.RecordBatch.from_arrays([pa.array(columns[c], k) if c in columns else pa.nulls(rows, k) for c, k in zip(names, kinds, strict=True)], names=names)

    def flush(parts: list[tuple[np.ndarray, np.ndarray, np.ndarray]]) -> Iterator[pa.RecordBatch]:
        doc, step, key = (np.concatenate(c) for c in zip(*parts, strict=True))
        order = np.lexsort((doc, key))
        doc, step, key = doc[order], step[order], key[order]
        edges = A.group_edges(key)
        first, size = edges[:-1], np.diff(edges)
        # Of equal keys here the smallest document goes on; all of them are known to be members.
        member = np.repeat(size > 1, size)
        sent = []
        for kind, at in ((0, first), (2, np.flatnonzero(member))):
            for bucket, here in by_bucket(A.bucket_of(key[at], buckets)):
                here = at[here]
                here = here[np.argsort(doc[here], kind="stable")]
                sent.append((kind, bucket, A.pack(doc[here], step[here].astype(np.uint8), key[here] & A.U((1 << KEY_BITS) - 1))))
        kind, bucket, payload = zip(*sent, strict=True)
        yield batch_of(len(kind), kind=kind, bucket=bucket, payload=payload)

    def send(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        parts, n = [], 0
        for batch in batches:
            for part in A.slices(batch, "text", STEP_BYTES):
                docs = np.asarray(part.column("doc"))
                text, key = shingles(A.texts_of(part.column("text")), words)
                edges = A.group_edges(text)
                size, d1, d2 = (np.zeros(len(docs), np.int64) for _ in range(3))
                if len(text):
                    who = text[edges[:-1]]
                    size[who] = np.diff(edges)
                    d1[who] = np.add.reduceat(A.mix(key), edges[:-1]).view(np.int64)
                    d2[who] = np.add.reduceat(A.mix(key + A.U(0x9E3779B97F4A7C15)), edges[:-1]).view(np.int64)
                bucket = A.spark_hash(docs, buckets).astype(np.int32)
                yield batch_of(len(docs), kind=np.ones(len(docs), np.int32), bucket=bucket, doc=docs, n=size, d1=d1, d2=d2)
                (at, step, tile), (which, need_step, need) = tile_keys(text, key, percent)
                if len(at):
                    # Which step and how many tiles go in the places of the hashes.
                    wanted = docs[which]
                    yield batch_of(len(which), kind=np.full(len(which), 3, np.int32), bucket=A.spark_hash(wanted, buckets).astype(np.int32), doc=wanted, n=need, d1=need_step)
                    parts.append((docs[at], step, tile))
                    n += len(at)
                if n >= GATHER:
                    yield from flush(parts)
                    parts, n = [], 0
        if n:
            yield from flush(parts)

    return send


def _members(table: pa.Table) -> pa.Table:
    """Documents of the tiles of a bucket that have two or more; what is known of documents passes."""
    A.trim()
    kinds = np.asarray(table.column("kind"))
    passing = table.filter(pa.array((kinds == 1) | (kinds == 3)))
    none_yet = (np.zeros(0, np.int64), np.zeros(0, np.uint8), np.zeros(0, np.uint64))
    found, alone = [none_yet], [none_yet]
    tiles = table.filter(pa.array((kinds == 0) | (kinds == 2)))
    for kind, payload in zip(tiles.column("kind").to_pylist(), tiles.column("payload").to_pylist(), strict=True):
        (found if kind == 2 else alone).append(tuple(A.unpack(payload)))
    doc, step, key = (np.concatenate(c) for c in zip(*alone, strict=True))
    order = np.argsort(key, kind="stable")
    edges = A.group_edges(key[order])
    more = order[np.repeat(np.diff(edges) > 1, np.diff(edges))]
    found.append((doc[more], step[more], key[more]))
    doc, step, key = (np.concatenate(c) for c in zip(*found, strict=True))
    whole = key | A.U(table.column("bucket")[0].as_py() << KEY_BITS)
    none = pa.nulls(len(doc), pa.int64())
    met = [pa.array(np.zeros(len(doc), np.int32)), pa.array(whole.view(np.int64)), pa.array(step.astype(np.int64)), pa.array(doc), none, none, none]
    names = ["kind", "key", "step", "doc", "n", "d1", "d2"]
    known = [passing.column(c) if c not in ("key", "step") else pa.nulls(len(passing), pa.int64()) for c in names]
    return pa.concat_tables([pa.table(met, names=names), pa.table(known, names=names)])


def _sets(words: int):
    def sets(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part in A.slices(batch, "text", STEP_BYTES):
                text, key = shingles(A.texts_of(part.column("text")), words)
                edges = A.group_edges(text)
                own = [key[a:b] for a, b in zip(edges[:-1], edges[1:], strict=True)]
                columns = [part.column("doc").take(pa.array(text[edges[:-1]])), pa.array([bitmap(k).tobytes() for k in own], pa.binary()), pa.array([k.tobytes() for k in own], pa.binary())]
                yield pa.RecordBatch.from_arrays(columns, names=["doc", "bits", "shingles"])

    return sets


def _only(bitmap: np.ndarray):
    def only(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            yield batch.filter(pa.array(passes(bitmap, A.mix(np.asarray(batch.column("doc")).view(np.uint64)))))

    return only


def _marks(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        mark = A.mix(np.asarray(batch.column("doc")).view(np.uint64)).view(np.int64)
        yield pa.RecordBatch.from_arrays([pa.array(mark)], names=["mark"])


def _numbers(column: pa.Array) -> list[np.ndarray]:
    return [np.frombuffer(x.as_buffer(), np.uint64) for x in column]


def _verify(percent: int):
    def verify(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            sides = [_numbers(batch.column(c)) for c in ("a_set", "a_bits", "b_set", "b_bits")]
            yes = pa.array([linked(*pair, percent) for pair in zip(*sides, strict=True)], pa.bool_())
            yield batch.select(["a", "b"]).filter(yes)

    return verify


def _compare_block(percent: int):
    """Links between documents of one block that stand apart and another block's documents, of other components.

    A link between two components is enough.
    """

    def compare(table: pa.Table) -> pa.Table:
        A.trim()
        table = table.combine_chunks()
        docs, parts, apart = (table.column(c).to_pylist() for c in ("doc", "component", "apart"))
        sets, bits = (_numbers(table.column(c)) for c in ("shingles", "bits"))
        parent = {p: p for p in parts}

        def root(p: int) -> int:
            while parent[p] != p:
                parent[p] = parent[parent[p]]
                p = parent[p]
            return p

        size, words = np.array([len(s) for s in sets]), np.array([len(b) for b in bits])
        levels: dict[int, np.ndarray] = {}

        def level(n: int) -> np.ndarray:
            if n not in levels:
                levels[n] = np.array([folded(b, n) if len(b) >= n else np.zeros(n, np.uint64) for b in bits])
            return levels[n]

        other = np.flatnonzero(~np.array(apart, bool))
        links = []
        for x in np.flatnonzero(apart):
            near = other[(percent * size[other] <= 100 * size[x]) & (percent * size[x] <= 100 * size[other])]
            if not len(near):
                continue
            # Bit counts of all of them at once; what they allow is intersected.
            n = int(min(words[x], words[near].min()))
            own, them = folded(bits[x], n), level(n)[near]
            most = np.minimum(size[x] - np.bitwise_count(own & ~them).sum(1), size[near] - np.bitwise_count(them & ~own).sum(1))
            for y in near[(100 + percent) * most >= percent * (size[near] + size[x])]:
                if root(parts[x]) != root(parts[y]) and linked(sets[x], bits[x], sets[y], bits[y], percent):
                    parent[root(parts[x])] = root(parts[y])
                    links.append((docs[x], docs[y]))
        return pa.table({"a": pa.array([k[0] for k in links], pa.int64()), "b": pa.array([k[1] for k in links], pa.int64())})

    return compare


def _late_links(members: DataFrame, so_far: DataFrame, sets: DataFrame, percent: int) -> DataFrame:
    """Links that the comparisons with the smallest documents have missed.

    They are between documents of one tile that are not connected. All tiles with such documents and the
    same smallest document are one group. In a group one component is the largest; its documents need no
    comparison with each other. All others stand apart: block by block they meet the blocks of the whole
    group, so that a group with few of them costs little more than reading it, whatever its size.
    """
    placed = members.join(so_far.withColumnRenamed("node", "doc"), "doc", "left").withColumn("component", F.coalesce("component", "doc"))
    placed = staged(placed)
    # Of two documents in a tile one is the smallest, and they have been compared.
    seen = placed.groupBy("key").agg(F.count("*").alias("size"), F.min("component").alias("low"), F.max("component").alias("high"), F.min("doc").alias("group"))
    open_tiles = seen.filter("size > 2 AND low <> high").select("key", "group")
    grouped = staged(placed.join(open_tiles, "key").select("doc", "component", "group").distinct())

    parts = grouped.groupBy("group", "component").agg(F.count("*").alias("n"))
    largest = parts.groupBy("group").agg(F.sum("n").alias("all"), F.max(F.struct("n", (-F.col("component")).alias("first"))).alias("most"))
    largest = largest.select("group", "all", (F.col("all") - F.col("most.n")).alias("apart"), (-F.col("most.first")).alias("largest"))
    sized = grouped.join(largest, "group")
    blocks = lambda n: F.ceil(F.col(n) / BLOCK).cast("int")
    block = lambda n: F.pmod(F.xxhash64("doc"), blocks(n)).cast("int")
    numbers = lambda n: F.explode(F.sequence(F.lit(0), blocks(n) - 1))
    everyone = sized.select("group", numbers("apart").alias("i"), block("all").alias("j"), "doc", "component", F.lit(False).alias("apart"))
    standing = sized.filter(F.col("component") != F.col("largest"))
    standing = standing.select("group", block("apart").alias("i"), numbers("all").alias("j"), "doc", "component", F.lit(True).alias("apart"))
    met = everyone.unionByName(standing).join(sets, "doc")
    return staged(met.groupBy("group", "i", "j").applyInArrow(_compare_block(percent), "a long, b long"))


def similar_groups(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", words: int = 5, percent: int = 80) -> DataFrame:
    """``doc_id``, ``n_shingles`` and ``component_id`` of each row of ``docs``.

    A document's set is its distinct ``words``-word shingles, of words between blanks with A-Z in lower
    case; with fewer words the whole sequence is one shingle. Two documents link when 100 times the
    intersection of their sets is ``percent`` times the union or more. ``component_id`` is the smallest
    id that links reach. All links count, but not each is returned: equal sets are one class, and
    between connected documents no further link is looked for.

    A null, empty or blank text has no shingle, links with nothing, and is its own component. Rows of
    equal id are one document with the links of all of them. A null id links with nothing and has a
    null component. Other columns do not come back, whatever their names. An empty table gives an empty
    result.
    """
    if not 50 <= percent <= 100:
        raise ValueError("percent must be from 50 to 100")
    texts = docs.select(F.col(id_col).cast("long").alias("doc"), F.col(text_col).cast("string").alias("text"))
    named = texts.filter("doc IS NOT NULL")
    buckets = 2 * buckets_for(named, "text")  # tiles take more room than the texts they come from
    sent = named.mapInArrow(_send(words, percent, buckets), _SENT)
    first = staged(sent.groupBy("bucket").applyInArrow(_members, _MET), "kind")
    stats = first.filter("kind = 1").select("doc", "n", "d1", "d2")

    # Classes of equal sets, each by its smallest document.
    classes = stats.filter("n > 0").groupBy("n", "d1", "d2").agg(F.min("doc").alias("least"))
    equal = staged(stats.join(classes, ["n", "d1", "d2"]).select("doc", "least"))
    speakers = equal.filter("doc = least").select("doc")

    # A document that shares fewer tiles than a partner would is in no pair: passages in common are not enough.
    met = first.filter("kind = 0").select("key", "step", "doc")
    needs = first.filter("kind = 3").select("doc", F.col("d1").alias("step"), F.col("n").alias("need"))
    shared = met.groupBy("doc", "step").agg(F.count("*").alias("tiles"))
    enough = shared.join(needs, ["doc", "step"]).filter("tiles >= need").select("doc", "step").distinct()
    members = staged(met.join(enough, ["doc", "step"], "left_semi").join(speakers, "doc", "left_semi").select("key", "doc"))
    centres = members.groupBy("key").agg(F.min("doc").alias("centre"), F.max("doc").alias("last")).filter("centre < last")
    pairs = staged(members.join(centres, "key").filter("doc <> centre").select(F.col("doc").alias("a"), F.col("centre").alias("b")).distinct())

    needed = staged(pairs.select(F.col("a").alias("doc")).unionByName(pairs.select(F.col("b").alias("doc"))).distinct())
    # Few texts are needed again: a bitmap drops most others where they are read, the join the rest.
    wanted = bitmap_of(needed.mapInArrow(_marks, "mark long"), WANTED_BITS)
    some = named.mapInArrow(_only(wanted), named.schema)
    sets = staged(some.join(needed, "doc", "left_semi").mapInArrow(_sets(words), _SETS))
    a, b = (sets.select(F.col("doc").alias(s), F.col("shingles").alias(f"{s}_set"), F.col("bits").alias(f"{s}_bits")) for s in "ab")
    links = staged(pairs.join(a, "a").join(b, "b").select("a", "b", "a_set", "a_bits", "b_set", "b_bits").mapInArrow(_verify(percent), "a long, b long"))
    so_far = staged(components(links.unionByName(equal.select(F.col("doc").alias("a"), F.col("least").alias("b")))))

    late = _late_links(members, so_far, sets, percent)
    if late.isEmpty():
        grouped = so_far
    else:
        # Components are joined where a late link leads from one to another.
        named = {s: so_far.select(F.col("node").alias(s), F.col("component").alias(f"{s}_part")) for s in "ab"}
        between = late.join(named["a"], "a", "left").join(named["b"], "b", "left")
        between = between.select(F.coalesce("a_part", "a").alias("a"), F.coalesce("b_part", "b").alias("b"))
        joined = components(between).select(F.col("node").alias("component"), F.col("component").alias("root"))
        nodes = so_far.unionByName(between.select(F.explode(F.array("a", "b")).alias("node"), F.col("node").alias("component")))
        grouped = nodes.join(joined, "component", "left").select("node", F.coalesce("root", "component").alias("component")).distinct()
    known = stats.select(F.col("doc").alias("doc_id"), F.col("n").alias("n_shingles")).join(grouped, F.col("doc_id") == F.col("node"), "left")
    known = known.select("doc_id", "n_shingles", F.coalesce("component", "doc_id").alias("component_id"))
    nameless = texts.filter("doc IS NULL").select("text").mapInArrow(_count_only(words), "n_shingles long")
    none = F.lit(None).cast("long")
    return known.unionByName(nameless.select(none.alias("doc_id"), "n_shingles", none.alias("component_id")))


def _count_only(words: int):
    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part in A.slices(batch, "text"):
                text, _ = shingles(A.texts_of(part.column("text")), words)
                yield pa.RecordBatch.from_arrays([pa.array(np.bincount(text, minlength=part.num_rows), pa.int64())], names=["n_shingles"])

    return count


#: Numbers from here on are for rows that their id does not tell apart.
_OWN_NUMBER = 1 << 62


def one_of_each(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", words: int = 5, percent: int = 80) -> DataFrame:
    """One row of each group of similar texts, with all columns: that of the smallest id.

    Groups are those of ``similar_groups``, but of rows: rows that share an id, or have none, are rows of their
    own and come after all others, in the order in which they are stored. Of rows with equal texts one stays.
    Null, empty and blank texts are like no other and all stay. An empty table gives an empty result.
    """
    row = F.struct(*[F.col(f"`{c}`") for c in docs.columns]).alias("row")
    rows = docs.select(F.col(id_col).cast("long").alias("doc"), F.col(text_col).cast("string").alias("text"), row)
    # Few ids are shared as a rule, so the rows that need a number of their own are written once more.
    shared = staged(rows.groupBy("doc").count().filter((F.col("count") > 1) | F.col("doc").isNull() | (F.col("doc") >= _OWN_NUMBER)).select("doc"))
    if shared.isEmpty():
        numbered = rows
    else:
        odd = rows.join(shared.withColumnRenamed("doc", "other"), F.col("doc").eqNullSafe(F.col("other")), "left_semi")
        odd = staged(odd.withColumn("doc", F.lit(_OWN_NUMBER) + F.monotonically_increasing_id()))
        numbered = rows.join(shared, "doc", "left_anti").filter("doc IS NOT NULL").unionByName(odd)
    groups = similar_groups(numbered.select("doc", "text"), "doc", "text", words, percent)
    gone = groups.filter("component_id < doc_id").select(F.col("doc_id").alias("doc"))
    return numbered.join(gone, "doc", "left_anti").select("row.*")
