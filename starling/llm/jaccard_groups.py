"""Operator 10: exact n-gram Jaccard join of a corpus with itself by a token-group matrix.

Two documents link when 100 * |A & B| >= percent * |A | B| over their distinct word shingles.
The result names each document's connected component; every link between different texts
counts, though none between documents already known to be connected is worked out twice.

1. ``signatures``: one pass computes per document its set size, a 128-bit fingerprint of the
   set, a few min-hashes and a parity sketch; documents of one fingerprint are one *class*.
2. Similar classes are put into groups: classes that share a min-hash meet in blocks, and what
   links there forms the groups.
3. The token-group matrix holds, for each group, the union of its members' prefix tokens.  If
   A and B link, the first |A| - ceil(p|A|) + m tokens of A in any fixed order share m tokens (all
   they share, if that is less) with the same prefix of B, so only classes whose prefix meets another
   group's union in m = ``SHARED`` tokens become its queries.  Tokens that many documents hold come
   last in the order, so common passages rarely are in a prefix.
4. Groups are opened in blocks of at most ``BLOCK`` members.  The overlap of a query and a member is
   bounded from their sketches: each bit is the parity of the tokens that hash to it, so differing
   bits never outnumber the differing tokens.  Only classes whose bound allows a link
   bring their sets; pairs are compared exactly, nearest first, until a query is linked to the block.

Hot cases: copies collapse into classes by partial aggregation; a min-hash or group shared by a
third of all rows is cut into salted blocks, which later blocks of other hashes and groups connect.
Only flags of a fixed-size bitmap, and tokens counted as common, reach the driver.
"""

from __future__ import annotations

from collections.abc import Iterable, Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from starling.llm.common import settle, small_batches, stored, text_slices
from starling.llm.components import components
from starling.llm.words import Words, distinct_sorted, mix64, windows

MIN_HASHES = 3
SHARED = 4  # tokens that the prefixes of linked sets share: more of them, fewer chance meetings and longer prefixes
BLOCK, BLOCK_TOKENS = 256, 1 << 21
SKETCH_BITS = 1024
SKETCHED_BITS = 1 << 19  # sketches worked out at once (or one, if it is longer)
BITMAP_BITS = 1 << 25  # 4 MB of flags, whatever the corpus
COMMON_IN_TASK = 16  # a token of so many documents of one task is a candidate common token
COUNTED_TOKENS = 3 << 20  # tokens a task holds until it counts them
COMMON_TOKENS = 1 << 18  # at most so many (the commonest) are ordered last; the rest keeps hash order
_SALTS = mix64(np.arange(1, MIN_HASHES + 1, dtype=np.uint64))
_SKETCH_SALT = np.uint64(0x5851F42D4C957F2D)


def shingle_sets(text: pa.Array, k: int) -> tuple[np.ndarray, np.ndarray]:
    """Sorted distinct shingle hashes of every document and their ``first`` offsets.  Words are
    lower-cased (A-Z); a document of under ``k`` words is one shingle, one without words none."""
    words = Words(text, lower=True)
    return distinct_sorted(*windows(words.hashes(), words.first, k, whole_short=True))


def sketches(sets: np.ndarray, first: np.ndarray) -> list[bytes]:
    """Every set's parity bits, as many as the next power of two of its size, at least ``SKETCH_BITS``:
    differing bits of two sketches never outnumber the differing tokens, and sketches as large as
    their sets hold enough bits to tell unlike sets apart."""
    n = np.diff(first)
    bits = np.maximum(SKETCH_BITS, 1 << np.ceil(np.log2(np.maximum(n, 1))).astype(np.int64))
    begin, out, x = np.concatenate([[0], np.cumsum(bits)]), [], 0
    while x < len(n):
        y = max(x + 1, int(np.searchsorted(begin, begin[x] + SKETCHED_BITS, "right")) - 1)
        held, edge = sets[first[x]:first[y]], begin[x:y + 1] - begin[x]
        at = np.repeat(edge[:-1], n[x:y]) + (mix64(held ^ _SKETCH_SALT) & np.repeat(bits[x:y] - 1, n[x:y]).astype(np.uint64)).astype(np.int64)
        packed = np.packbits((np.bincount(at, minlength=edge[-1]) & 1).astype(np.uint8))
        out += [packed[a:b].tobytes() for a, b in zip(edge[:-1] // 8, edge[1:] // 8, strict=True)]
        x = y
    return out


def differing_bits(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """Differing bits of every row of ``a`` and row of ``b`` (uint64 words); longer sketches are
    folded onto the shorter ones, which keeps them parities of the same tokens."""
    while a.shape[1] > b.shape[1]:
        a = a[:, :a.shape[1] // 2] ^ a[:, a.shape[1] // 2:]
    while b.shape[1] > a.shape[1]:
        b = b[:, :b.shape[1] // 2] ^ b[:, b.shape[1] // 2:]
    step = max(1, (1 << 18) // max(1, b.size))
    return np.concatenate([np.bitwise_count(a[x:x + step, None] ^ b).sum(2, dtype=np.int64) for x in range(0, len(a), step)])


def _long(values: np.ndarray) -> pa.Array:
    return pa.array(np.ascontiguousarray(values).view(np.int64))


def _least(total: int, percent: int) -> int:
    """ceil(percent * total / 100)."""
    return -(-percent * total // 100)


def linked(a: np.ndarray, b: np.ndarray, percent: int) -> bool:
    """Whether two sorted distinct sets link."""
    if min(len(a), len(b)) < _least(max(len(a), len(b)), percent) or not len(a):
        return False
    both = len(np.intersect1d(a, b, assume_unique=True))
    return 100 * both >= percent * (len(a) + len(b) - both)


def repeated(held: list[np.ndarray], times: int) -> tuple[np.ndarray, np.ndarray]:
    """The values found ``times`` times or more in the arrays, which are given up, and their counts."""
    if not held:
        return np.zeros(0, np.uint64), np.zeros(0, np.int64)
    values = np.concatenate(held)
    held.clear()
    values.sort()
    found = np.unique(values[:len(values) - times + 1][values[times - 1:] == values[:len(values) - times + 1]]) if len(values) >= times else values[:0]
    return found, np.searchsorted(values, found, "right") - np.searchsorted(values, found, "left")


def signatures(docs: DataFrame, k: int) -> DataFrame:
    """Rows (doc_id, n, fp_hi, fp_lo, h0.., sketch) of all documents, and (token, df) rows of tokens
    that are common within a task (doc rows have a null token)."""
    schema = ("doc_id long, n long, fp_hi long, fp_lo long, "
              + ", ".join(f"h{i} long" for i in range(MIN_HASHES)) + ", sketch binary, token long, df long")
    names = [f.split()[0] for f in schema.split(", ")]

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        seen: dict[int, int] = {}
        held: list[np.ndarray] = []

        def count() -> None:
            tokens, counts = repeated(held, COMMON_IN_TASK)
            for t, c in zip(tokens.tolist(), counts.tolist(), strict=True):
                seen[t] = seen.get(t, 0) + c

        for batch in batches:
            for a, b in text_slices(batch.column(1)):
                part = batch.slice(a, b - a)
                sets, first = shingle_sets(part.column(1), k)
                held.append(sets)
                if sum(map(len, held)) >= COUNTED_TOKENS:
                    count()
                n = np.diff(first)
                prints = [xxhash.xxh3_128_intdigest(sets[x:y].tobytes()) for x, y in zip(first[:-1], first[1:], strict=True)]
                mins = []
                for salt in _SALTS:
                    low = np.zeros(len(n), np.uint64)
                    if len(sets):
                        low[n > 0] = np.minimum.reduceat(mix64(sets ^ salt), first[:-1][n > 0])
                    mins.append(_long(low))
                none = pa.nulls(len(n), pa.int64())
                yield pa.RecordBatch.from_arrays(
                    [part.column(0), pa.array(n.astype(np.int64)),
                     _long(np.array([p >> 64 for p in prints], np.uint64)),
                     _long(np.array([p & (1 << 64) - 1 for p in prints], np.uint64)), *mins,
                     pa.array(sketches(sets, first), pa.binary()), none, none], names)
        count()
        if seen:
            none = pa.nulls(len(seen), pa.int64())
            yield pa.RecordBatch.from_arrays(
                [none] * (4 + MIN_HASHES) + [pa.nulls(len(seen), pa.binary()), _long(np.array(list(seen), np.uint64)), pa.array(list(seen.values()), pa.int64())], names)

    return docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text")).mapInArrow(run, schema)


def common_tokens(rows: DataFrame) -> np.ndarray:
    """The tokens that come last in the prefix order, commonest last (a bounded list: it only
    steers the order, any order gives the same links)."""
    got = (rows.where("token IS NOT NULL").groupBy("token").agg(F.sum("df").alias("df"))
           .orderBy(F.desc("df"), "token").limit(COMMON_TOKENS).collect())
    return np.array([r["token"] for r in reversed(got)], np.int64).view(np.uint64)


def prefix(tokens: np.ndarray, common: np.ndarray, rank: np.ndarray, percent: int) -> np.ndarray:
    """The first |set| - ceil(p|set|) + ``SHARED`` tokens: rare ones in hash order, then common ones by rank."""
    size = len(tokens) - int(_least(len(tokens), percent)) + SHARED if len(tokens) else 0
    if len(common):
        at = np.minimum(np.searchsorted(common, tokens), len(common) - 1)
        hit = common[at] == tokens
        if hit.any():
            late = tokens[hit][np.argsort(rank[at[hit]])]
            tokens = np.concatenate([tokens[~hit], late])
    return tokens[:size]


def prefix_tokens(docs: DataFrame, k: int, percent: int, common: np.ndarray) -> DataFrame:
    """(token, fp_lo, early, often): prefix tokens of all documents, one copy of each set per task.

    ``early``: it is among the first |set| - ceil(2p/(1+p) |set|) + ``SHARED``; of two sets that link, the
    first ``SHARED`` shared tokens are early in the shorter one, as they share p/(1+p) of their added sizes.
    ``often``: it is on the common list."""
    order = np.argsort(common, kind="stable")
    shared = docs.sparkSession.sparkContext.broadcast((common[order], order))

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        listed, rank = shared.value
        done: set[int] = set()
        for batch in batches:
            for a, b in text_slices(batch.column(0)):
                sets, first = shingle_sets(batch.column(0).slice(a, b - a), k)
                tokens, owners, sizes = [], [], []
                for x, y in zip(first[:-1], first[1:], strict=True):
                    mark = xxhash.xxh3_128_intdigest(sets[x:y].tobytes()) & (1 << 64) - 1
                    if y > x and mark not in done:
                        done.add(mark)
                        tokens.append(prefix(sets[x:y], listed, rank, percent))
                        owners.append(mark)
                        sizes.append(int(y - x))
                if tokens:
                    token = np.concatenate(tokens)
                    owner = np.repeat(np.array(owners, np.uint64), [len(t) for t in tokens])
                    early = np.concatenate([np.arange(len(t)) < n + (-2 * percent * n // (100 + percent)) + SHARED
                                            for t, n in zip(tokens, sizes, strict=True)])
                    yield pa.RecordBatch.from_arrays([_long(token), _long(owner), pa.array(early), pa.array(np.isin(token, listed))],
                                                     ["token", "fp_lo", "early", "often"])

    return docs.select("text").mapInArrow(run, "token long, fp_lo long, early boolean, often boolean")


def shared_tokens(tokens: DataFrame) -> DataFrame:
    """(token, fp_lo, early) of the tokens that different sets hold (some rows twice).  Common tokens
    pass as they are; the others are brought together by token and streamed in sorted order, so
    that a row or two are all that a task holds."""
    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        token, owner, early = np.zeros(0, np.int64), np.zeros(0, np.int64), np.zeros(0, bool)
        for batch in batches:
            token = np.concatenate([token, batch.column(0).to_numpy()])
            owner = np.concatenate([owner, batch.column(1).to_numpy()])
            early = np.concatenate([early, batch.column(2).to_numpy(zero_copy_only=False)])
            keep = np.ones(len(token), bool)
            keep[1:] = (token[1:] != token[:-1]) | (owner[1:] != owner[:-1])
            token, owner, early = token[keep], owner[keep], early[keep]
            same = token[1:] == token[:-1]
            hit = np.zeros(len(token), bool)
            hit[1:] |= same
            hit[:-1] |= same
            yield pa.RecordBatch.from_arrays([pa.array(token[hit]), pa.array(owner[hit]), pa.array(early[hit])], ["token", "fp_lo", "early"])
            tail = 2 if len(token) > 1 and same[-1] else 1  # the last row still has to meet the next batch
            token, owner, early = token[-tail:], owner[-tail:], early[-tail:]

    rare = (tokens.where("NOT often").select("token", "fp_lo", "early").repartition("token")
            .sortWithinPartitions("token", "fp_lo").mapInArrow(run, "token long, fp_lo long, early boolean"))
    return rare.unionByName(tokens.where("often").select("token", "fp_lo", "early"))


def bitmap(ids: DataFrame, column: str) -> np.ndarray:
    """Flags of the hashed values of ``column``: a fixed-size filter that never misses one."""
    place = F.pmod(F.xxhash64(column), F.lit(BITMAP_BITS))
    rows = (ids.select((place + 1).alias("p")).groupBy(F.expr("bitmap_bucket_number(p)").alias("bucket"))
            .agg(F.expr("bitmap_construct_agg(bitmap_bit_position(p))").alias("bits")).collect())
    flags = np.zeros(BITMAP_BITS // 8 + 4096, np.uint8)
    for r in rows:  # buckets and places are numbered from 1
        at = (r["bucket"] - 1) * 4096
        flags[at:at + 4096] = np.frombuffer(r["bits"], np.uint8)
    return flags


def fetched_sets(docs: DataFrame, wanted: DataFrame, k: int) -> DataFrame:
    """(fp_hi, fp_lo, tokens) of the classes in ``wanted`` (with their ``rep`` doc_id): one pass
    computes sets only where the bitmap of wanted ids has a flag."""
    shared = docs.sparkSession.sparkContext.broadcast(bitmap(wanted, "rep"))

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        flags, done = shared.value, set()
        for batch in batches:
            p = batch.column(0).to_numpy()
            batch = batch.filter(pa.array((flags[p >> 3] >> (p & 7) & 1).astype(bool)))
            for a, b in text_slices(batch.column(1)):
                sets, first = shingle_sets(batch.column(1).slice(a, b - a), k)
                rows = []
                for x, y in zip(first[:-1], first[1:], strict=True):
                    mark = xxhash.xxh3_128_intdigest(sets[x:y].tobytes())
                    if y > x and mark not in done:
                        done.add(mark)
                        rows.append((mark, sets[x:y].tobytes()))
                yield pa.RecordBatch.from_arrays(
                    [_long(np.array([m >> 64 for m, _ in rows], np.uint64)),
                     _long(np.array([m & (1 << 64) - 1 for m, _ in rows], np.uint64)),
                     pa.array([s for _, s in rows], pa.binary())], ["fp_hi", "fp_lo", "tokens"])

    return (docs.select(F.pmod(F.xxhash64(F.col("doc_id").cast("long")), F.lit(BITMAP_BITS)).alias("p"), "text")
            .mapInArrow(run, "fp_hi long, fp_lo long, tokens binary"))


def allowed_pairs(a: tuple, b: tuple, percent: int) -> np.ndarray:
    """Rows (i, j, differing bits) of the pairs whose sizes and sketches allow a link; ``a`` and ``b``
    are (sizes, sketches).  Sketch lengths that differ by more than a factor of 2 mean sizes that do not fit."""
    (n_a, raw_a), (n_b, raw_b) = a, b
    of_a, of_b = np.array([len(r) for r in raw_a], np.int64), np.array([len(r) for r in raw_b], np.int64)
    found = [np.zeros((0, 3), np.int64)]
    for u in np.unique(of_a):
        rows = np.flatnonzero(of_a == u)
        left = np.frombuffer(b"".join(raw_a[r] for r in rows), np.uint64).reshape(len(rows), -1)
        for v in np.unique(of_b[(2 * of_b >= u) & (of_b <= 2 * u)]):
            cols = np.flatnonzero(of_b == v)
            least, most = np.minimum(n_a[rows][:, None], n_b[cols]), np.maximum(n_a[rows][:, None], n_b[cols])
            fits = 100 * least >= percent * most
            if fits.any():
                right = np.frombuffer(b"".join(raw_b[c] for c in cols), np.uint64).reshape(len(cols), -1)
                differ = differing_bits(left, right)
                x, y = np.nonzero(fits & ((100 + percent) * differ <= (100 - percent) * (least + most)))
                found.append(np.column_stack([rows[x], cols[y], differ[x, y]]))
    out = np.concatenate(found)
    return out[np.argsort(out[:, 2], kind="stable")]


def _blocks(batches: Iterable[pa.RecordBatch]) -> Iterator[tuple[tuple[int, int], bool, list[np.ndarray], list[bytes]]]:
    """(block and salt, whether it is a new one, [role, cls, n], payloads) of consecutive rows of one block."""
    at = None
    for batch in batches:
        block, salt = batch.column(0).to_numpy(), batch.column(1).to_numpy()
        cuts = np.flatnonzero((block[1:] != block[:-1]) | (salt[1:] != salt[:-1])) + 1
        for a, b in zip([0, *cuts.tolist()], [*cuts.tolist(), len(block)], strict=True):
            if b > a:
                key, part = (int(block[a]), int(salt[a])), batch.slice(a, b - a)
                yield key, key != at, [part.column(c).to_numpy() for c in (2, 3, 4)], part.column(5).to_pylist()
                at = key


def promising_seats(seats: DataFrame, classes: DataFrame, percent: int, mutual: bool) -> DataFrame:
    """The seats whose class may link with another of its block, by their sketches.  ``seats``: (block,
    salt, role, cls).  Either all members of a block meet each other (``mutual``), or its queries
    (role 1) stream past its members (role 0); a block has at most about ``BLOCK`` members.  Blocks are
    renamed by what is left of their members if they are ``mutual``, so that equal blocks are one."""
    rows = (seats.join(classes.select("cls", "n", "sketch"), "cls").repartition("block", "salt")
            .sortWithinPartitions("block", "salt", "role").select("block", "salt", "role", "cls", "n", "sketch"))

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        key, cls, n, raw, hit = None, np.zeros(0, np.int64), np.zeros(0, np.int64), [], np.zeros(0, bool)

        def out(role: int, picked: np.ndarray) -> pa.RecordBatch:
            k = len(picked)
            block, salt = (xxhash.xxh3_64_intdigest(np.sort(picked).tobytes()) - (1 << 63), 0) if mutual else key
            return pa.RecordBatch.from_arrays([pa.array([v] * k, t) for v, t in ((block, pa.int64()), (salt, pa.int64()), (role, pa.int32()))]
                                              + [pa.array(picked, pa.int64())], ["block", "salt", "role", "cls"])

        def members() -> np.ndarray:
            if not mutual:
                return cls[hit]
            pairs = allowed_pairs((n, raw), (n, raw), percent)
            return cls[np.unique(pairs[pairs[:, 0] != pairs[:, 1], 0])]

        for now, new, (role, c, size), sketch in _blocks(batches):
            if new:
                if key is not None:
                    yield out(0, members())
                key, cls, n, raw, hit = now, cls[:0], n[:0], [], hit[:0]
            own = role == 0
            cls, n = np.concatenate([cls, c[own]]), np.concatenate([n, size[own]])
            raw, hit = raw + [s for s, o in zip(sketch, own, strict=True) if o], np.concatenate([hit, np.zeros(own.sum(), bool)])
            asked = np.flatnonzero(~own)
            for x in range(0, len(asked), 1024):
                q = asked[x:x + 1024]
                pairs = allowed_pairs((size[q], [sketch[r] for r in q]), (n, raw), percent)
                hit[pairs[:, 1]] = True
                yield out(1, c[q][np.unique(pairs[:, 0])])
        if key is not None:
            yield out(0, members())

    found = rows.mapInArrow(run, "block long, salt long, role int, cls long")
    return found.distinct() if mutual else found


def links_in_blocks(seats: DataFrame, docs: DataFrame, classes: DataFrame, k: int, percent: int, mutual: bool) -> DataFrame:
    """Links (a, b) by whole sets, nearest pairs first, none between classes that the block has connected
    already: as many as connect what is connected in the block (``mutual``), or one a query."""
    seats = stored(promising_seats(seats, classes, percent, mutual), "jaccard-seats")
    settle(docs.sparkSession)
    wanted = stored(seats.join(classes.select("cls", "fp_hi", "fp_lo", "n", "rep"), "cls"), "jaccard-wanted")
    rows = (fetched_sets(docs, wanted, k).join(wanted, ["fp_hi", "fp_lo"]).repartition("block", "salt")
            .sortWithinPartitions("block", "salt", "role", "cls").select("block", "salt", "role", "cls", "n", "tokens"))

    def parts(sets: list[np.ndarray]) -> tuple[np.ndarray, list[bytes]]:
        n = np.array([len(t) for t in sets], np.int64)
        return n, sketches(np.concatenate([*sets, np.zeros(0, np.uint64)]), np.concatenate([[0], np.cumsum(n)]))

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: dict[int, np.ndarray] = {}
        known, names = None, []

        def out(found: list[tuple[int, int]]) -> pa.RecordBatch:
            return pa.RecordBatch.from_arrays([pa.array([f[e] for f in found], pa.int64()) for e in (0, 1)], ["a", "b"])

        def spanning() -> list[tuple[int, int]]:
            names, sets = list(held), list(held.values())
            own, found, top = parts(sets), [], list(range(len(sets)))

            def root(x: int) -> int:
                while top[x] != x:
                    top[x] = x = top[top[x]]
                return x

            for i, j, _ in allowed_pairs(own, own, percent).tolist() if len(sets) > 1 else ():
                if i < j and root(i) != root(j) and linked(sets[i], sets[j], percent):
                    top[root(i)] = root(j)
                    found.append((names[i], names[j]))
            return found

        for _, new, (role, c, _), raw in _blocks(batches):
            if new:
                if mutual and held:
                    yield out(spanning())
                held, known = {}, None
            sets = [np.frombuffer(r, np.uint64) for r in raw]
            held.update({int(x): t for x, t, r in zip(c, sets, role, strict=True) if r == 0})  # copies from other tasks once
            asked = {int(x): t for x, t, r in zip(c, sets, role, strict=True) if r == 1}
            if asked and held:
                if known is None:
                    names, known = list(held), parts(list(held.values()))
                queries, found = list(asked), {}
                for i, j, _ in allowed_pairs(parts(list(asked.values())), known, percent).tolist():
                    if i not in found and names[j] != queries[i] and linked(asked[queries[i]], held[names[j]], percent):
                        found[i] = (queries[i], names[j])
                yield out(list(found.values()))
        if mutual and held:
            yield out(spanning())

    return rows.mapInArrow(run, "a long, b long")


def _salted(df: DataFrame, by: list[str], size: int) -> DataFrame:
    """``df`` (by..., cls, n, ...) plus ``salt``: the rows of one ``by`` value are dealt over blocks of about
    ``size`` rows and ``BLOCK_TOKENS`` tokens; ``__n`` rows hold the value."""
    blocks = df.groupBy(*by).agg(F.count(F.lit(1)).alias("__n"), F.sum("n").alias("__tokens"))
    return (df.join(blocks, by).withColumn("salt", F.pmod(F.xxhash64("cls"), F.ceil(F.greatest(
        F.col("__n") / F.lit(size), F.col("__tokens") / F.lit(BLOCK_TOKENS))))).drop("__tokens"))


def star_seats(classes: DataFrame) -> DataFrame:
    """Blocks of classes that share a min-hash."""
    keyed = classes.select("cls", "n", F.posexplode(F.array(*[F.col(f"h{i}") for i in range(MIN_HASHES)])).alias("i", "h"))
    return (_salted(keyed, ["i", "h"], BLOCK).where("__n > 1")
            .select(F.xxhash64("i", "h").alias("block"), "salt", F.lit(0).alias("role"), "cls"))


def cross_seats(tokens: DataFrame, classes: DataFrame, groups: DataFrame, percent: int) -> DataFrame:
    """Blocks that hold a group's members against the queries from other groups.

    A class queries a group if its prefix meets the group's union of prefixes in ``SHARED`` tokens (or as many
    as a link takes, if fewer) with holders whose sizes fit, early in the shorter set; of two groups the smaller
    one's classes are the queries.
    """
    spark = classes.sparkSession
    owners = classes.join(groups, "cls").select("cls", "n", "fp_lo", "grp")
    owners = owners.join(owners.groupBy("grp").agg(F.count(F.lit(1)).alias("members")), "grp")
    # each token of a class once, though several tasks hold copies
    held = stored(tokens.join(owners, "fp_lo").select("fp_lo", "token", "early", "cls", "n", "grp", "members").distinct().drop("fp_lo"), "jaccard-held")
    settle(spark)
    # the token-group matrix, with the sizes of the members that hold the token
    several = held.groupBy("token").agg(F.min("grp").alias("a"), F.max("grp").alias("b")).where("a <> b").select("token")
    matrix = held.join(several, "token").groupBy("token", "grp", "members").agg(
        F.min("n").alias("n_min"), F.max("n").alias("n_max"), F.min(F.when(F.col("early"), F.col("n"))).alias("n_early"))
    matrix = stored(matrix, "jaccard-matrix")
    settle(spark)
    queries = held.withColumnsRenamed({"grp": "own", "members": "own_members"})
    meets = (queries.join(matrix, "token").where("own <> grp")
             .where("own_members < members OR (own_members = members AND own < grp)")
             .where((F.lit(100) * F.col("n") >= F.lit(percent) * F.col("n_min")) & (F.lit(100) * F.col("n_max") >= F.lit(percent) * F.col("n")))
             .where("(early AND n_max >= n) OR n_early <= n")
             .groupBy("cls", "n", "grp").agg(F.count(F.lit(1)).alias("shared"))
             .where(F.col("shared") >= F.least(F.lit(SHARED), F.ceil(F.lit(percent) * F.col("n") / F.lit(100)))).drop("shared"))
    meets = stored(meets, "jaccard-meets")
    settle(spark)
    inside = (_salted(owners.join(meets.select("grp").distinct(), "grp").select("cls", "n", "grp"), ["grp"], BLOCK)
              .drop("__n").withColumnRenamed("salt", "part"))
    parts = inside.select("grp", "part").distinct()
    asked = _salted(meets, ["grp"], 4 * BLOCK).join(parts, "grp")
    block = F.xxhash64("grp", "part")
    turns = asked.select("grp", "part", "salt").distinct()
    return (asked.select(block.alias("block"), "salt", F.lit(1).alias("role"), "cls")
            .unionByName(inside.join(turns, ["grp", "part"]).select(block.alias("block"), "salt", F.lit(0).alias("role"), "cls")))


def jaccard_components(docs: DataFrame, k: int = 5, percent: int = 75) -> DataFrame:
    """Per row of ``docs``: doc_id, n_shingles, component_id (smallest doc_id reachable by links).

    Rows without words (null or empty text) have n_shingles 0 and link with nothing: their own
    doc_id.  Equal sets link, so repeated rows share a component; null doc_ids count as texts but
    never name a component unless it has no other id.  Other columns are ignored; an empty
    table gives an empty result.
    """
    small_batches(docs.sparkSession)
    docs = docs.select("doc_id", "text")
    rows = stored(signatures(docs, k), "jaccard-signatures")
    signed = rows.where("token IS NULL")
    grouped = (signed.where("n > 0").groupBy("n", "fp_hi", "fp_lo")
               .agg(F.min("doc_id").alias("rep"), F.min("sketch").alias("sketch"), *[F.min(f"h{i}").alias(f"h{i}") for i in range(MIN_HASHES)]))
    classes = stored(grouped.withColumn("cls", F.monotonically_increasing_id()), "jaccard-classes")
    near = stored(links_in_blocks(star_seats(classes), docs, classes, k, percent, mutual=True), "jaccard-near")
    groups = stored(components(classes.select("cls"), near, "cls", "grp"), "jaccard-groups")
    tokens = shared_tokens(prefix_tokens(docs, k, percent, common_tokens(rows)))
    far = links_in_blocks(cross_seats(tokens, classes, groups, percent), docs, classes, k, percent, mutual=False)
    links = stored(near.unionByName(far), "jaccard-links")
    found = components(classes.select("cls"), links, "cls", "component")
    named = classes.join(found, "cls").select("n", "fp_hi", "fp_lo", "component", "rep")
    names = named.groupBy("component").agg(F.min("rep").alias("component_id"))
    named = named.join(names, "component").select("n", "fp_hi", "fp_lo", "component_id")
    return (signed.join(named, ["n", "fp_hi", "fp_lo"], "left")
            .select("doc_id", F.col("n").alias("n_shingles"), F.coalesce("component_id", "doc_id").alias("component_id")))
