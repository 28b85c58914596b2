"""Near-duplicate groups: the exact N-gram Jaccard join, with set relations used to skip work.

A document's set holds its distinct word shingles, as 64-bit hashes. Equal sets of a block are one set, and equal sets of two
blocks are linked like any others. All sets share one order of
shingles, rare ones first, by exact counts. If two sets are similar enough, the leading parts of
both, their prefixes, share a shingle; so an index of the prefixes finds every pair. Its lists are cut by size and position:

* Index level: a list is cut into classes of size, each with the class above it, so that sets which can reach the threshold meet
  and others do not. The least set of such a part is its pivot. A set is compared with a pivot only if their positions in some
  list leave enough shingles for the overlap; otherwise the place is skipped.
* Answer level: sets that are linked to their pivot share its group, and their comparisons with each other are skipped, since
  they cannot change a component. What is not linked to the pivot is compared with all others of the part, in blocks of
  bounded size.

Every link is verified on whole sets. A component's id is its least document.

Rare first needs counts of the shingles that may stand in a prefix. Shingles below a fixed share of the hash
range, the counted ones, come first, by class of count; the others follow by hash. So all counts are
whole although most shingles are never sent. Texts cross an exchange once; see `packed`.

Cases: null or empty texts and texts without words have no shingles and are linked with nothing, each its own component. Fewer words
than the width form one shingle. Repeated rows are equal sets. A null id counts as the smallest, and a component that holds
it has the id null. Two different shingles in one pair of documents with one 64-bit hash are taken for one.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F

from trackloom.llm.common import as_bytes, map_batches, settle
from trackloom.llm.components import components
from trackloom.llm.ordering import LEAST
from trackloom.llm.packed import Keys, answer, ask, blocks_of, bucket_bits, from_owners, from_six, owners, six, starts_of
from trackloom.llm.repeats import BYTE, ODD, mix

U = np.uint64
#: Shingles whose hash lies below this share of the range are counted.
COUNTED = 0.3
#: Lists of more sets than this, a power of two, are cut by Spark's own aggregates and joins.
LONG = 4096
#: Sets of one part that are compared with each other in one task.
TOGETHER = 256
LOWER = bytes(c + 32 if 65 <= c <= 90 else c for c in range(256))
BASE = int(0x9E3779B97F4A7C15) | 1
UNBASE = pow(BASE, -1, 1 << 64)
BLANK = np.array([c == 32 or 9 <= c <= 13 for c in range(256)])


class Powers:
    """Powers of the base and of its inverse, as far as a text is long."""

    up = down = np.ones(1, dtype=np.uint64)

    @classmethod
    def reach(cls, n: int) -> None:
        while len(cls.up) < n:
            k = len(cls.up)
            cls.up = np.concatenate([cls.up, cls.up * U(pow(BASE, k, 1 << 64))])
            cls.down = np.concatenate([cls.down, cls.down * U(pow(UNBASE, k, 1 << 64))])


def shingles(text: bytes, width: int) -> np.ndarray:
    """Sorted distinct hashes of the shingles."""
    x = np.frombuffer(text.translate(LOWER), dtype=np.uint8)
    edges = np.diff(np.concatenate([[True], BLANK[x], [True]]).astype(np.int8))
    starts, ends = np.flatnonzero(edges == -1), np.flatnonzero(edges == 1)
    if not len(starts):
        return np.zeros(0, dtype=np.uint64)
    Powers.reach(len(x) + 1)
    sums = np.zeros(len(x) + 1, dtype=np.uint64)
    np.cumsum(BYTE[x] * Powers.up[: len(x)], out=sums[1:])
    words = mix((sums[ends] - sums[starts]) * Powers.down[starts] + (ends - starts).astype(np.uint64) * ODD[2])
    n = min(width, len(words))
    out = np.full(len(words) - n + 1, n, dtype=np.uint64)
    for k in range(n):
        out = mix(out * ODD[1] + words[k : k + len(out)])
    return np.unique(out)


def share(n, percent: int):
    """The least overlap that a set of n shingles needs with any partner."""
    return -(-n * percent // 100)


class Sets:
    """The sets of a block's documents, in order of id and text: number `block << 32 | place`."""

    def __init__(self, docs: pa.Table, width: int):
        texts, keys = as_bytes(docs.column("text")), docs.column("key").to_pylist()
        order = sorted(range(len(texts)), key=lambda k: (keys[k], texts[k]))
        self.keys, self.ids = [keys[k] for k in order], [docs.column("id")[k].as_py() for k in order]
        self.sets = [shingles(texts[k], width) for k in order]
        #: For each document the first one with an equal set.
        self.rep, known = [], {}
        for k, s in enumerate(self.sets):
            self.rep.append(known.setdefault(hashlib.blake2b(s.tobytes(), digest_size=16).digest(), k) if len(s) else k)

    def counted(self, percent: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """(place, shingle, counted) of what may stand in a prefix: all counted shingles, others as far as they are too few."""
        limit, parts = U(int(COUNTED * 2**64)), []
        for k, s in enumerate(self.sets):
            if len(s) and self.rep[k] == k:
                low = int(np.searchsorted(s, limit))
                n = max(low, len(s) - share(len(s), percent) + 1)
                parts.append((np.full(n, k), s[:n], np.arange(n) < low))
        none = np.zeros(0, dtype=np.int64), np.zeros(0, dtype=np.uint64), np.zeros(0, dtype=bool)
        return tuple(np.concatenate(c) for c in zip(*parts, strict=True)) if parts else none


def judge_counts(hi: np.ndarray, lo: np.ndarray, owner: np.ndarray) -> np.ndarray:
    """Class of a shingle by the sum of its counts: 0 for one set, else 1 for two, 2 up to four, 3 up to eight."""
    new = starts_of(hi)
    total = np.add.reduceat(owner, np.flatnonzero(new)) if len(owner) else owner
    return np.ceil(np.log2(total)).astype(np.uint8)[np.cumsum(new) - 1]


#: A document with its set's number, a set by its number, or a bucket's postings. Bucket -1 holds those of long lists.
ENTRY = "sid long, rep long, key long, id long, n long, tokens binary, bucket long, token binary, owner binary, size binary, pos binary"
MEMBER = "pivot long, sid long, meets boolean"


def size_class(size, percent: int):
    """Sets of classes more than one apart cannot reach the threshold. The slack keeps that true of rounded logarithms."""
    return np.floor(np.log(size) / (np.log(100 / percent) * (1 + 1e-9))).astype(np.int64)


def positions_meet(size_a, pos_a, size_b, pos_b, percent: int):
    """Whether two sets that meet at these positions first can still overlap enough."""
    left_a, left_b = size_a - pos_a, size_b - pos_b
    need = (size_a + size_b) * percent
    return (left_a * (100 + percent) >= need) & (left_b * (100 + percent) >= need)


def parts_of(token: np.ndarray, sid: np.ndarray, size: np.ndarray, pos: np.ndarray, percent: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(pivot, set, meets) of all parts of the lists, each pair once."""
    level = size_class(size, percent)
    twice = [np.concatenate([x, x]) for x in (token, sid, size, pos, level)]
    at = np.concatenate([level, level - 1])
    order = np.lexsort((twice[1], twice[2], at, twice[0]))
    token, sid, size, pos, level = (x[order] for x in twice)
    at = at[order]
    first = np.flatnonzero(starts_of(token, at))
    length = np.diff(np.append(first, len(token)))
    # a part without a set of its own class is the part of the class above
    used = (length > 1) & (level[first] == at[first])
    first, length = first[used], length[used]
    pivot = np.repeat(first, length - 1)
    member = np.arange(len(pivot)) - np.repeat(np.cumsum(length - 1) - (length - 1), length - 1) + pivot + 1
    meets = positions_meet(size[pivot], pos[pivot], size[member], pos[member], percent)
    pivot, member = sid[pivot], sid[member]
    order = np.lexsort((~meets, member, pivot))
    pivot, member, meets = pivot[order], member[order], meets[order]
    once = starts_of(pivot, member) & (pivot != member)
    return pivot[once], member[once], meets[once]


def parts_of_long_lists(posted: DataFrame, percent: int) -> DataFrame:
    """The same for plain rows (token, sid, size, pos) of lists of any length: no task sees a whole list."""
    level = F.floor(F.log(F.col("size").cast("double")) / F.lit(float(np.log(100 / percent) * (1 + 1e-9))))
    own = posted.withColumn("level", level.cast("long"))
    twice = own.withColumn("at", F.explode(F.array("level", F.col("level") - 1)))
    least = twice.groupBy("token", "at").agg(F.min(F.struct("size", "sid", "pos", "level")).alias("first"))
    least = least.where(F.col("first.level") == F.col("at")).select(F.col("token").alias("list"), F.col("at").alias("part"), "first")
    met = twice.join(least, (F.col("token") == F.col("list")) & (F.col("at") == F.col("part"))).where(F.col("sid") != F.col("first.sid"))
    meets = positions_meet(F.col("first.size"), F.col("first.pos"), F.col("size"), F.col("pos"), percent)
    return met.select(F.col("first.sid").alias("pivot"), "sid", meets.alias("meets"))


def common(own: np.ndarray, other: np.ndarray) -> int:
    at = np.searchsorted(own, other)
    return int((own[np.minimum(at, len(own) - 1)] == other).sum())


def verify(pairs: DataFrame, sets: DataFrame, percent: int) -> DataFrame:
    """Links (a, b) among candidate pairs. A set travels once for each of its pivots; busy pivots are spread."""
    degree = pairs.groupBy("a").agg(F.count("*").alias("degree"))
    spread = F.pmod(F.xxhash64("b"), F.ceil(F.col("degree") / TOGETHER))
    dealt = pairs.join(degree, "a").select("a", spread.cast("int").alias("part"), "b")
    both = dealt.union(dealt.select("a", "part", F.col("a").alias("b")).distinct())
    loaded = both.join(sets, F.col("b") == F.col("sid")).select("a", "part", "b", "tokens")

    def run(key: tuple, rows: pa.Table) -> pa.Table:
        a = key[0].as_py()
        held = {b: np.frombuffer(t, dtype=np.uint64) for b, t in zip(rows.column("b").to_pylist(), rows.column("tokens").to_pylist(), strict=True)}
        own, good = held.pop(a), []
        for b, other in held.items():
            n = common(own, other)
            if 100 * n >= percent * (len(own) + len(other) - n):
                good.append(b)
        return pa.table({"a": pa.array([a] * len(good), pa.int64()), "b": pa.array(good, pa.int64())})

    return loaded.groupBy("a", "part").applyInArrow(run, "a long, b long")


def verify_rest(members: DataFrame, labels: DataFrame, sets: DataFrame, percent: int) -> DataFrame:
    """Links between the sets of a part that are not all in its pivot's group.

    The pivot's group is the core of the part. Blocks of the rest meet blocks of the core and each other. Of the links found
    in a task those stay that join groups, so there are fewer than sets.
    """
    label = labels.select(F.col("node"), "label")
    named = members.join(label, F.col("sid") == F.col("node"), "left").select("pivot", "sid", F.coalesce("label", "sid").alias("group"))
    of_pivot = label.select(F.col("node").alias("of"), F.col("label").alias("core_label"))
    named = named.join(of_pivot, F.col("pivot") == F.col("of"), "left").withColumn("rest", F.col("group") != F.coalesce("core_label", "pivot"))
    counts = named.groupBy(F.col("pivot").alias("of_pivot")).agg(F.count_if("rest").alias("n_rest"), F.count_if(~F.col("rest")).alias("n_core"))
    counts = counts.where((F.col("n_rest") > 1) | ((F.col("n_rest") == 1) & (F.col("n_core") > 0)))
    blocks = {n: F.ceil(F.col(n) / TOGETHER).cast("int") for n in ("n_rest", "n_core")}
    placed = named.join(counts, F.col("pivot") == F.col("of_pivot")).withColumns({f"{n}_blocks": c for n, c in blocks.items()})
    own = F.pmod(F.xxhash64("sid"), F.when(F.col("rest"), F.col("n_rest_blocks")).otherwise(F.col("n_core_blocks"))).cast("int")
    placed = placed.withColumn("own", own)

    def up_to(n: str):
        return F.when(F.col(n) > 0, F.sequence(F.lit(0), F.col(n) - 1)).otherwise(F.expr("cast(array() as array<int>)"))

    with_core = F.transform(up_to("n_core_blocks"), lambda c: F.struct(F.lit(True).alias("core"), F.col("own").alias("u"), c.alias("v")))
    with_rest = F.transform(up_to("n_rest_blocks"), lambda r: F.struct(F.lit(False).alias("core"), F.least("own", r).alias("u"), F.greatest("own", r).alias("v")))
    of_core = F.transform(up_to("n_rest_blocks"), lambda r: F.struct(F.lit(True).alias("core"), r.alias("u"), F.col("own").alias("v")))
    meetings = F.when(F.col("rest"), F.concat(with_core, with_rest)).otherwise(of_core)
    dealt = placed.select("pivot", F.col("sid").alias("b"), "group", "rest", "own", F.explode(meetings).alias("m")).select("pivot", "b", "group", "rest", "own", "m.*")
    loaded = dealt.join(sets, F.col("b") == F.col("sid")).drop("sid")

    def run(key: tuple, rows: pa.Table) -> pa.Table:
        core, u, v = (k.as_py() for k in key[1:4])
        ids, group, rest, own = (rows.column(n).to_numpy() for n in ("b", "group", "rest", "own"))
        held = [np.frombuffer(t, dtype=np.uint64) for t in rows.column("tokens").to_pylist()]
        order = np.argsort(ids, kind="stable")
        left = [k for k in order if rest[k] and own[k] == u]
        right = [k for k in order if not rest[k]] if core else [k for k in order if own[k] == v]
        a, b = [], []
        label = np.unique(group, return_inverse=True)[1]
        for x, linked in zip(left, shared_enough([held[k] for k in left], [held[k] for k in right], percent), strict=True):
            others = np.array([right[j] for j in np.flatnonzero(linked)], dtype=np.int64)
            # one link to each group that x does not belong to yet
            for old, at in zip(*np.unique(label[others], return_index=True), strict=True):
                if old != label[x]:
                    y = others[at]
                    a.append(min(ids[x], ids[y]))
                    b.append(max(ids[x], ids[y]))
                    label[label == old] = label[x]
        return pa.table({"a": pa.array(a, pa.int64()), "b": pa.array(b, pa.int64())})

    return loaded.groupBy("pivot", "core", "u", "v").applyInArrow(run, "a long, b long").distinct()


def shared_enough(left: list[np.ndarray], right: list[np.ndarray], percent: int) -> np.ndarray:
    """For each set on the left which on the right reach the threshold, by products of incidence matrices over shared shingles."""
    if not left or not right:
        return np.zeros((len(left), len(right)), dtype=bool)
    shared = np.intersect1d(np.concatenate(left), np.concatenate(right))
    size_l, size_r = np.array([len(s) for s in left]), np.array([len(s) for s in right])
    overlap = np.zeros((len(left), len(right)))
    for at in range(0, len(shared), 8192):
        some = shared[at : at + 8192]
        overlap += incidence(left, some) @ incidence(right, some).T
    return 100 * overlap >= percent * (size_l[:, None] + size_r[None, :] - overlap)


def incidence(sets: list[np.ndarray], tokens: np.ndarray) -> np.ndarray:
    out = np.zeros((len(sets), len(tokens)), dtype=np.float32)
    for k, s in enumerate(sets):
        at = np.searchsorted(tokens, s)
        hit = tokens[np.minimum(at, len(tokens) - 1)] == s
        out[k, at[hit]] = 1.0
    return out


def near_duplicates(
    docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", width: int = 5, percent: int = 80, long: int = LONG, carry: str | None = None
) -> DataFrame:
    """(id, n_shingles, component_id, stays) of every document; `stays` marks one row of each component.

    Two documents are linked when their sets have at least `percent` hundredths of their union in common. With `carry`, a
    column of whole numbers, each row is named by that number and not by its id.
    """
    blocks, count = blocks_of(docs, id_col, text_col, carry)
    bits = bucket_bits(count)

    def keys_of(held: Sets) -> tuple:
        place, token, is_counted = held.counted(percent)
        none = np.zeros(int(is_counted.sum()), dtype=np.int64)
        keys = Keys(mix(token[is_counted]), none.astype(np.uint64), none)
        keys.owner = np.bincount(keys.of, minlength=len(keys.hi))
        return place, token, is_counted, keys

    def ask_counts(block: int, table: pa.Table, _: None) -> pa.Table:
        return keys_of(Sets(table, width))[3].questions(block, bits)

    def entries(block: int, table: pa.Table, got: pa.Table) -> pa.Table:
        held = Sets(table, width)
        place, token, is_counted, keys = keys_of(held)
        group = np.full(len(token), 255, dtype=np.int64)
        group[is_counted] = keys.answers(got, 1, bits)[keys.of]
        order = np.lexsort((token, group, place))
        place, token, group = place[order], token[order], group[order]
        size = np.array([len(s) for s in held.sets], dtype=np.int64)[place] if len(place) else place
        starts = np.flatnonzero(starts_of(place))
        pos = np.arange(len(place)) - np.repeat(starts, np.diff(np.append(starts, len(place))))
        used = (pos < size - share(size, percent) + 1) & (group > 0)
        posted = np.unique(place[used]).tolist()
        hi, sid = mix(token[used]), (block << 32) + place[used]
        size, pos, group = size[used], pos[used], group[used]
        long_list = (group < 255) & (group >= long.bit_length())
        bucket = np.where(long_list, -1, (hi >> U(64 - bits)).astype(np.int64))
        order = np.argsort(bucket, kind="stable")
        edges = np.flatnonzero(starts_of(bucket[order])).tolist()
        rows = {name: [] for name in ("bucket", "token", "owner", "size", "pos")}
        for s, e in zip(edges, [*edges[1:], len(order)], strict=True):
            at = order[s:e]
            values = int(bucket[at[0]]), six(hi[at]), owners(sid[at]), owners(size[at]), owners(pos[at])
            for column, value in zip(rows.values(), values, strict=True):
                column.append(value)
        base, n = block << 32, len(held.sets)
        documents = {"sid": [base + k for k in range(n)], "rep": [base + k for k in held.rep], "key": held.keys, "id": held.ids, "n": [len(s) for s in held.sets]}
        loaded = {"sid": [base + k for k in posted], "tokens": [held.sets[k].tobytes() for k in posted]}
        columns = {}
        for field in ENTRY.split(", "):
            name, kind = field.split(" ")
            values = [*documents.get(name, [None] * n), *loaded.get(name, [None] * len(posted)), *rows.get(name, [None] * len(rows["bucket"]))]
            columns[name] = pa.array(values, pa.int64() if kind == "long" else pa.binary())
        return pa.table(columns)

    def unpacked(rows: pa.Table | pa.RecordBatch) -> tuple[np.ndarray, ...]:
        token = [from_six(x) for x in rows.column("token").to_pylist()]
        rest = [[from_owners(x) for x in rows.column(n).to_pylist()] for n in ("owner", "size", "pos")]
        return tuple(np.concatenate(x) if x else np.zeros(0, dtype=np.int64) for x in (token, *rest))

    def candidates(key: tuple, rows: pa.Table) -> pa.Table:
        found = parts_of(*unpacked(rows), percent)
        return pa.table({n: pa.array(x) for n, x in zip(("pivot", "sid", "meets"), found, strict=True)})

    def plain(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            token, *rest = unpacked(b)
            yield pa.RecordBatch.from_arrays([pa.array(x.astype(np.int64)) for x in (token.view(np.int64), *rest)], names=["token", "sid", "size", "pos"])

    counts = answer(ask(blocks, ask_counts), 1, judge_counts)
    stored = settle(ask(blocks, entries, counts, ENTRY), "sets")
    every = stored.where("rep is not null").select("sid", "rep", "key", "id", "n")
    sets = stored.where("tokens is not null").select("sid", "tokens")
    posted = stored.where("bucket is not null").select("bucket", "token", "owner", "size", "pos")
    short = posted.where("bucket >= 0").groupBy("bucket").applyInArrow(candidates, MEMBER)
    rows = map_batches(posted.where("bucket < 0").drop("bucket"), plain, "token long, sid long, size long, pos long")
    members = short.unionByName(parts_of_long_lists(rows, percent)).groupBy("pivot", "sid").agg(F.max("meets").alias("meets"))
    members = settle(members, "members")

    pairs = members.where("meets").select(F.least("pivot", "sid").alias("a"), F.greatest("pivot", "sid").alias("b")).distinct()
    links = settle(verify(pairs, sets, percent), "links")
    labels = components(links)
    more = settle(verify_rest(members, labels, sets, percent), "links")
    if not more.isEmpty():
        labels = components(links.union(more))

    labelled = every.join(labels, F.col("rep") == F.col("node"), "left").withColumn("group", F.coalesce("label", "rep"))
    least = labelled.groupBy(F.col("group").alias("of")).agg(F.min(F.struct("key", "sid")).alias("first"))
    out = labelled.join(least, F.col("group") == F.col("of"))
    component = F.when(F.col("first.key") == LEAST, F.lit(None)).otherwise(F.col("first.key"))
    stays = F.col("sid") == F.col("first.sid")
    return out.select(F.col("id").alias(carry or id_col), F.col("n").alias("n_shingles"), component.alias("component_id"), stays.alias("stays"))


#: Number of a row, among the columns of docs.
ROW = "staying_row_"


def keep_one(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", width: int = 5, percent: int = 80) -> DataFrame:
    """docs with one row of each group of near duplicates. Rows are told apart by number, so ids may be null or shared."""
    # settled, so that a row has one number however often it is read
    rows = settle(docs.withColumn(ROW, F.monotonically_increasing_id()), "rows")
    staying = near_duplicates(rows, id_col, text_col, width, percent, carry=ROW).where("stays").select(ROW)
    return rows.join(staying, ROW, "left_semi").select(*[F.col(f"`{c}`") for c in docs.columns])
