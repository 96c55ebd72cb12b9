"""SimHash near-duplicates of a stated similarity: anchor points find candidates, the texts' whole shingle sets decide.

A text's shingles are its runs of ``SHINGLE`` words, letters A-Z folded; a shorter text is one shingle. Two texts are linked if their
sets of shingles have a Jaccard similarity of ``LEAST`` or more. Texts with the same words are taken together first, by 128 bits of hash.

The fingerprint is a SimHash of ``BITS`` bits over the set of shingles. Sets of a similarity of 0.8 have a cosine of 8/9, so each bit
differs with a probability of ``FLIP`` (0.15): far more bits than a covering code over all of them could bridge. So anchors
are placed in many views. A view takes 15 bits of the fingerprint and a few free ones; its anchors are the words of the Hamming code
[15, 11] with any free bits, whose covering radius is 1. Within a view the threshold is 0: a fingerprint is replicated to every anchor
within 1 + 0, and all in one ball meet. ``views`` takes as many views as a pair of exactly 0.8 needs to meet in one but for a
probability of ``MISS``; more similar ones are missed more rarely still. Free bits grow with the number of texts, so that the
fingerprints of an anchor stay about as many.

Per anchor, fingerprints that differ in ``near`` of ``CARRIED`` bits or fewer are candidates (a pair of 0.8 differs in more with a
probability of ``MISS``). What hangs together over all anchors is one crowd, so that a text travels once and not once a view. A crowd is
compared by its whole sets by breadth-first search, which compares each text with those not yet reached; one of over ``BLOCK`` texts
in blocks of about as many, each against every other, so that a group of any size is cut into bounded pieces and loses no link.

Null and empty texts have the same words, none, and so are near-duplicates of each other. Repeated rows and ties have the
same words too. An empty table gives an empty result. A very long text costs time in proportion, and 8 bytes a distinct shingle.
"""

from __future__ import annotations

import functools
import math
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from millrace.llm import simhash
from millrace.llm._arrow import named, steps, texts
from millrace.llm._hash import U, byte_table, mix, numbers, run_hashes, word_hashes
from millrace.llm._store import forget, stored

#: Words of a shingle, and the least similarity of a link as a fraction.
SHINGLE, LEAST = 5, (4, 5)
#: Bits of a fingerprint, those that travel to the anchors, and bits of a view that the code takes.
BITS, CARRIED, CODE = 512, 256, 15
#: The chance that a bit differs at the least similarity: the angle between the sets as a share of a half turn.
FLIP = math.acos(2 * LEAST[0] / (LEAST[0] + LEAST[1])) / math.pi
MISS = 1e-5
#: Fingerprints of an anchor that free bits aim at: more make fewer views, and so fewer replicas, but more comparisons.
CROWDED = 1024
#: Fingerprints of an anchor that are compared all with all, texts of a block, and fingerprints replicated at a time.
CROWD, BLOCK, CHUNK = 1 << 12, 512, 1 << 12
#: Edges between candidates that one task thins out.
EDGES = 1 << 17
TABLE, FACTORS = byte_table(5, fold=True), numbers(55, SHINGLE)
SEEDS = numbers(56, BITS // 64)
LANES = U(0x0101010101010101)


def near(bits: int = CARRIED) -> int:
    """The most of ``bits`` bits in which two texts of the least similarity differ, but for a probability of ``MISS``."""
    chance, k = (1 - FLIP) ** bits, 0
    total = chance
    while total < 1 - MISS:
        k += 1
        chance *= (bits - k + 1) / k * FLIP / (1 - FLIP)
        total += chance
    return k


def free_bits(texts_: int) -> int:
    return max(0, math.ceil(math.log2(max(1, texts_) / CROWDED)) - 11)


@functools.lru_cache(maxsize=8)
def views(free: int) -> np.ndarray:
    """The numbers of the bits that each view takes, those of the code first; by the chance that a pair meets in a view, enough views."""
    same = 1 - FLIP
    # In one ball: equal; or apart by one of 15 bits or by two, and the place in the ball fits in 2 of 16 cases.
    ball = same**CODE + 2 / 16 * (CODE * FLIP * same ** (CODE - 1) + math.comb(CODE, 2) * FLIP**2 * same ** (CODE - 2))
    count = math.ceil(math.log(MISS) / math.log1p(-ball * same**free))
    return np.array([np.argsort(mix(numbers(60 + v, BITS)), kind="stable")[: CODE + free] for v in range(count)])


def shingles(text: str) -> np.ndarray:
    """The distinct hashes of the text's shingles, in order."""
    words = word_hashes(text.encode(), TABLE)
    return np.unique(run_hashes(words, min(SHINGLE, len(words)), FACTORS)) if len(words) else words


def fingerprint(found: np.ndarray) -> bytes:
    """Bit i is set if it is set in over half of the shingles' hashes. Counts are kept in the bytes of whole numbers."""
    counts = np.zeros((BITS // 64, 8, 8), np.int64)
    for i in range(0, len(found), 1 << 15):
        hashes = mix(found[i : i + (1 << 15), None] ^ SEEDS)
        cuts = np.arange(0, len(hashes), 255)
        for bit in range(8):
            sums = np.add.reduceat(hashes >> U(bit) & LANES, cuts, axis=0)
            counts[:, :, bit] += sums.view(np.uint8).reshape(len(cuts), -1, 8).sum(axis=0, dtype=np.int64)
    return np.packbits(2 * counts.ravel() > len(found), bitorder="little").tobytes()


def anchors(fps: np.ndarray, free: int) -> tuple[np.ndarray, np.ndarray]:
    """Rows (number of the fingerprint, anchor) for fingerprints as rows of bytes; an anchor's top bits name its view."""
    bits = np.unpackbits(fps, axis=1, bitorder="little")
    flips = simhash.offsets(CODE, free, 1)
    powers = U(1) << np.arange(CODE + free, dtype=U)
    which, where = [], []
    for k, view in enumerate(views(free)):
        taken = bits[:, view]
        value = (taken * powers).sum(axis=1, dtype=U)
        syndrome = np.bitwise_xor.reduce(taken[:, :CODE] * np.arange(1, CODE + 1, dtype=np.uint8), axis=1)
        for s in range(CODE + 1):
            at = np.flatnonzero(syndrome == s)
            which.append(np.repeat(at, len(flips[s])))
            where.append((value[at, None] ^ flips[s]).ravel() | U(k) << U(48))
    return np.concatenate(which), np.concatenate(where).view(np.int64)


def apart(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """In how many bits each of the fingerprints ``a`` (rows of 64-bit words) differs from each of ``b``."""
    return sum(np.bitwise_count(a[:, None, k] ^ b[None, :, k]).astype(np.uint16) for k in range(a.shape[1]))


def groups(fps: np.ndarray, most: int) -> Iterator[np.ndarray]:
    """The places of fingerprints (rows of 64-bit words) that hang together by ``most`` differing bits or fewer, if more than one does."""
    left = np.arange(len(fps))
    if len(left) <= CROWD:  # most have no neighbour, which a comparison of all in strips shows
        strip = (1 << 18) // max(1, len(fps)) + 1
        left = np.flatnonzero(np.concatenate([(apart(fps[i : i + strip], fps) <= most).sum(axis=1) > 1 for i in range(0, len(fps), strip)]))
    while len(left):
        queue, left, reached = [left[0]], left[1:], []
        while queue:
            now = queue.pop()
            reached.append(now)
            hit = np.bitwise_count(fps[left] ^ fps[now]).sum(axis=1, dtype=np.int64) <= most
            queue += left[hit].tolist()
            left = left[~hit]
        if len(reached) > 1:
            yield np.sort(reached)


def similar(both: np.ndarray | int, a: np.ndarray | int, b: np.ndarray | int) -> np.ndarray | bool:
    """Whether sets of ``a`` and ``b`` shingles with ``both`` in common are linked."""
    return both * LEAST[1] >= (a + b - both) * LEAST[0]


def forest(nodes: list[int], sets: list[np.ndarray]) -> list[tuple[int, int]]:
    """Edges (reached from, reached) that connect texts as all links between them do."""
    left, sizes = np.arange(len(nodes)), np.array(list(map(len, sets)))
    flat, owner = np.concatenate(sets), np.repeat(left, sizes)
    edges: list[tuple[int, int]] = []
    queue: list[int] = []
    while len(left):
        if not queue:
            queue, left = [int(left[0])], left[1:]
            flat, owner = flat[owner != queue[0]], owner[owner != queue[0]]
        now = queue.pop()
        if not sizes[now]:  # a text without words is like no other
            continue
        at = np.minimum(np.searchsorted(sets[now], flat), sizes[now] - 1)
        both = np.bincount(owner[sets[now][at] == flat], minlength=len(nodes))
        close = left[similar(both[left], sizes[left], sizes[now])]
        if len(close):
            edges += [(nodes[now], nodes[k]) for k in close]
            queue += close.tolist()
            left = np.setdiff1d(left, close, assume_unique=True)
            stay = ~np.isin(owner, close)
            flat, owner = flat[stay], owner[stay]
    return edges


def prints(docs: DataFrame, key: str, text: str) -> DataFrame:
    """(key, words, fp): a hash of every text's words, and its fingerprint."""

    def pass_(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        import xxhash

        for batch in steps(batches, "text"):
            found = texts(batch, "text")
            words = [xxhash.xxh3_128_digest(b" ".join(x.encode().lower().split())) for x in found]
            fps = [fingerprint(shingles(x)) for x in found]
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(words, pa.binary()), pa.array(fps, pa.binary())], names=["key", "words", "fp"])

    return named(docs, key=key, text=text).mapInArrow(pass_, "key long, words binary, fp binary")


def replicas(distinct: DataFrame, free: int) -> DataFrame:
    """(anchor, node, fp): the carried bits of every fingerprint at every anchor in reach, from (node, fp)."""

    def pass_(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for i in range(0, batch.num_rows, CHUNK):
                part = batch.slice(i, CHUNK)
                fps = np.frombuffer(b"".join(part.column(1).to_pylist()), np.uint8).reshape(part.num_rows, -1)
                which, where = anchors(fps, free)
                carried = pa.FixedSizeBinaryArray.from_buffers(pa.binary(CARRIED // 8), len(which), [None, pa.py_buffer(fps[which, : CARRIED // 8].tobytes())])
                yield pa.RecordBatch.from_arrays([pa.array(where), part.column(0).take(pa.array(which)), carried.cast(pa.binary())], names=["anchor", "node", "fp"])

    return distinct.select("node", "fp").mapInArrow(pass_, "anchor long, node long, fp binary")


def candidates(spread: DataFrame) -> DataFrame:
    """(a, b) from (anchor, node, fp): candidates, enough of them to connect what hangs together at any anchor."""
    most = near()

    def pass_(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        rest_a, rest_n, rest_f = np.empty(0, np.int64), np.empty(0, np.int64), np.empty((0, CARRIED // 64), U)

        def out(where: np.ndarray, nodes: np.ndarray, fps: np.ndarray) -> pa.RecordBatch:
            cuts = np.flatnonzero(np.diff(where)) + 1
            starts, ends = np.concatenate([[0], cuts]), np.append(cuts, len(where))
            found = [starts[k] + at for k in np.flatnonzero(ends - starts > 1) for at in groups(fps[starts[k] : ends[k]], most)]
            first = np.repeat(np.array([at[0] for at in found], np.int64), [len(at) - 1 for at in found])
            others = np.concatenate([np.empty(0, np.int64), *(at[1:] for at in found)])
            return pa.RecordBatch.from_arrays([pa.array(nodes[first]), pa.array(nodes[others])], names=["a", "b"])

        for batch in batches:
            rest_a, rest_n = (np.concatenate([r, np.asarray(c)]) for r, c in zip((rest_a, rest_n), batch.columns[:2], strict=True))
            rest_f = np.concatenate([rest_f, np.frombuffer(b"".join(batch.column(2).to_pylist()), U).reshape(batch.num_rows, -1)])
            if len(rest_a):
                done = np.searchsorted(rest_a, rest_a[-1])  # the last anchor may go on
                if done:
                    yield out(rest_a[:done], rest_n[:done], rest_f[:done])
                rest_a, rest_n, rest_f = rest_a[done:], rest_n[done:], rest_f[done:]
        if len(rest_a):
            yield out(rest_a, rest_n, rest_f)

    return spread.repartition("anchor").sortWithinPartitions("anchor", "node").mapInArrow(pass_, "a long, b long")


def thinned(edges: DataFrame) -> DataFrame:
    """(a, b): of the stored edges (a, b) enough to connect what all connect. Most repeat what edges of other views say."""

    def pass_(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        above: dict[int, int] = {}

        def root(x: int) -> int:
            while (up := above.get(x, x)) != x:
                above[x] = above.get(up, up)
                x = up
            return x

        def out() -> pa.RecordBatch:
            nodes = list(above)
            return pa.RecordBatch.from_arrays([pa.array(map(root, nodes), pa.int64()), pa.array(nodes, pa.int64())], names=["a", "b"])

        for batch in batches:
            for a, b in zip(*(c.to_pylist() for c in batch.columns), strict=True):
                x, y = root(a), root(b)
                if x != y:
                    above[max(x, y)] = min(x, y)
            if len(above) > EDGES:
                yield out()
                above.clear()
        yield out()

    return edges.coalesce(edges.count() // EDGES + 1).mapInArrow(pass_, "a long, b long")


def crowded(docs: DataFrame, roots: DataFrame) -> DataFrame:
    """(crowd, node, text): the texts of each group of candidates (node, root), in one crowd or in one for each two of its blocks."""
    members = stored(roots.unionAll(roots.select(F.col("root").alias("node"), "root").distinct()), "members")
    large = stored(members.groupBy("root").count().filter(F.col("count") > BLOCK).select("root", F.ceil(F.col("count") / BLOCK).cast("int").alias("blocks")), "large")
    placed = members.join(large, "root", "left").select("node", "root", F.coalesce("blocks", F.lit(1)).alias("blocks"))
    nodes = stored(placed, "nodes")
    # Only the texts of candidates are joined, so the others are not moved.
    some = stored(docs.join(simhash.sent(nodes), "node"), "texts")
    for done in (members, large, nodes):
        forget(done)
    own = F.pmod(F.xxhash64("node"), "blocks").cast("int")
    others = F.filter(F.sequence(F.lit(0), F.col("blocks") - 1), lambda k: (k != own) | (F.col("blocks") == 1))
    dealt = some.select("node", "text", "root", own.alias("own"), F.explode(others).alias("other"))
    # Groups whose hashes agree would be compared as one, which changes no link.
    return dealt.select(F.xxhash64("root", F.least("own", "other"), F.greatest("own", "other")).alias("crowd"), "node", "text")


def links(docs: DataFrame, spread: DataFrame) -> DataFrame:
    """(a, b): links between the texts (node, text), enough of them to connect what all links connect."""

    def pass_(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        now, nodes, sets = None, [], []

        def out(edges: list[tuple[int, int]]) -> pa.RecordBatch:
            cols = list(zip(*edges, strict=True)) or [(), ()]
            return pa.RecordBatch.from_arrays([pa.array(c, pa.int64()) for c in cols], names=["a", "b"])

        for piece in steps(batches, "text"):
            edges = []
            for crowd, node, text in zip(piece.column(0).to_pylist(), piece.column(1).to_pylist(), texts(piece, "text"), strict=True):
                if crowd != now:
                    if nodes:
                        edges += forest(nodes, sets)
                    now, nodes, sets = crowd, [], []
                nodes.append(node)
                sets.append(shingles(text))
            yield out(edges)
        if nodes:
            yield out(forest(nodes, sets))

    found = stored(candidates(spread).distinct(), "candidates")
    crowds = crowded(docs, simhash.components(thinned(found)))
    forget(found)
    return crowds.repartition("crowd").sortWithinPartitions("crowd", "node").mapInArrow(pass_, "a long, b long")


def near_duplicates(docs: DataFrame, key: str, text: str = "text") -> DataFrame:
    """(key, component): the smallest key reachable over links, itself included; ``key`` is a number no two rows share."""
    found = stored(prints(docs, key, text), "prints")
    # Equal words have equal fingerprints.
    distinct = stored(found.groupBy("words").agg(F.min("key").alias("node"), F.first("fp").alias("fp")), "distinct")
    spread = replicas(distinct, free_bits(distinct.count()))
    roots = simhash.components(links(named(docs, node=key, text=text), spread))
    named_ = stored(distinct.join(roots, "node", "left").select("words", F.coalesce("root", "node").alias("component")), "classes")
    forget(distinct)
    return found.select("key", "words").join(named_, "words").select("key", "component")
