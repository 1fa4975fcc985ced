"""Exact n-gram Jaccard self-join by T-occurrence search over inverted lists.

A document's set is its distinct ``n``-word shingles (64-bit hashes). Two documents
link when 100 * |A and B| >= ``percent`` * |A or B|. Documents with the same set form
one class; everything below runs on classes, so thousands of copies cost one.

1. One map pass gives each class its size, a 128-bit digest and a parity bitmap of its
   set, and a lossy count of shingles that are frequent within a batch. Summed over all
   batches these *heavy* shingles only decide an order (rare first), never a result.
2. Corpus-wide DivideSkip: a partner of A shares at least T = ceil(percent |A|) shingles
   with it, so with the T - 1 longest of A's inverted lists set aside it is found in one of
   the |A| - T + 1 short ones. A second map pass deals just the short lists' postings out,
   packed into arrays by hash bucket, where lists are merged by sorting: those of two or
   more classes become *canopies* (pivot, members), and every linked pair is inside some
   canopy. A heavy shingle's pivot is known beforehand, so its list never meets in one place.
3. Inside a canopy parity bitmaps (Hamming distance never exceeds the symmetric
   difference, so nothing linked is lost) leave the pairs of its pivot and of its medoid
   with the others, and all pairs of small canopies; large canopies are cut into blocks.
4. Left pairs go to the T-occurrence search: a query's inverted lists over its block are
   divided again; the short ones are merged into counts (an array over the block stands in
   for the heap), the long ones only probed by binary search for documents that can still
   reach the required overlap.
5. Components are contracted in Spark; then all members of a canopy that are still in
   different components are compared, by 3 and 4 again, and components contracted anew.

So a group of near copies costs its size, not its square, and no link between different
texts is lost. What remains quadratic is the second round of 5 inside one canopy, over
members that are still in different components: texts that share a short list and yet
aren't linked. It is dealt by pairs of blocks, so no task is larger than two blocks.

A class is named by 64 bits of its set's digest; where sets of different digests share
them, their names are mixed from all 128. Rows are told apart by their place in a written
table, not by id.

Defined results: null text, or no words: empty set, linked with nothing; fewer than
``n`` words: the whole sequence is one shingle; equal rows and equal texts under any ids,
repeated or null, link; a component has the smallest id of its rows (null if all are null);
texts are read whole, however long (some 50 bytes a character of the one in hand); ties are
broken by id, then by place; extra columns are ignored by ``components`` and kept by
``keep_one``, whatever they are called; an empty table gives an empty result.
"""

from __future__ import annotations

import hashlib
import math

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from rewardmill.llm.common import (
    checked_broadcast, connected_components, discard, free_name, give_back, materialise, ship, shuffle_partitions, slices,
)

BATCH_DOCS = 2_000
HEAVY_IN_BATCH = 8
HEAVY_TABLE = 200_000
CANOPY_BLOCK = 1_000
QUERY_BLOCK = 400
SMALL_CANOPY = 6
MEDOID_PROBES = 12

_SPACE = np.zeros(256, dtype=bool)
_SPACE[[32, 9, 10, 11, 12, 13]] = True
_BASE = 0x9E3779B97F4A7C15 | 1
_POWERS: dict[str, np.ndarray] = {"up": np.ones(1, np.uint64), "down": np.ones(1, np.uint64)}


def _powers(size: int) -> tuple[np.ndarray, np.ndarray]:
    if len(_POWERS["up"]) < size:
        size = max(size, 1 << 16)
        for name, base in (("up", _BASE), ("down", pow(_BASE, -1, 1 << 64))):
            steps = np.full(size, base, dtype=np.uint64)
            steps[0] = 1
            _POWERS[name] = np.cumprod(steps, dtype=np.uint64)
    return _POWERS["up"], _POWERS["down"]


def _mix(h: np.ndarray) -> np.ndarray:
    h = (h ^ (h >> np.uint64(33))) * np.uint64(0xFF51AFD7ED558CCD)
    h = (h ^ (h >> np.uint64(33))) * np.uint64(0xC4CEB9FE1A85EC53)
    return h ^ (h >> np.uint64(33))


def shingle_set(text: str | None, n: int = 5) -> np.ndarray:
    """Sorted distinct hashes of the text's n-word shingles (A-Z lower-cased)."""
    if not text:
        return np.empty(0, np.uint64)
    data = np.frombuffer(text.encode("utf-8", "surrogatepass").lower(), dtype=np.uint8)
    gap = np.empty(len(data) + 2, dtype=bool)
    gap[0] = gap[-1] = True
    gap[1:-1] = _SPACE[data]
    edges = np.flatnonzero(gap[1:] != gap[:-1])
    start, end = edges[::2], edges[1::2]
    if not len(start):
        return np.empty(0, np.uint64)
    up, down = _powers(len(data) + 1)
    sums = np.zeros(len(data) + 1, dtype=np.uint64)
    np.cumsum((data.astype(np.uint64) + np.uint64(1)) * up[: len(data)], out=sums[1:])
    words = _mix((sums[end] - sums[start]) * down[start] + (end - start).astype(np.uint64))
    size = min(n, len(words))
    last = len(words) - size + 1
    h = np.full(last, size if size < n else 0, dtype=np.uint64)
    for k in range(size):
        h = h * np.uint64(0x2545F4914F6CDD1D) + words[k : k + last]
    return np.unique(_mix(h))


def digest(tokens: np.ndarray, bits: int = 64) -> tuple[int, int]:
    """128 bits of a set in two numbers, the first cut to ``bits``."""
    raw = hashlib.blake2b(tokens.tobytes(), digest_size=16).digest()
    first = int.from_bytes(raw[:8], "little", signed=True)
    return first if bits == 64 else first & ((1 << bits) - 1), int.from_bytes(raw[8:], "little", signed=True)


class Naming:
    """Names of sets: the digest's first part, or where several sets share that, all of it."""

    def __init__(self, shared: frozenset[int] = frozenset(), bits: int = 64):
        self.shared, self.bits = shared, bits

    def __call__(self, tokens: np.ndarray) -> int:
        first, second = digest(tokens, self.bits)
        if first not in self.shared:
            return first
        raw = hashlib.blake2b(f"{first}:{second}".encode(), digest_size=8).digest()
        return int.from_bytes(raw, "little", signed=True)


def parity_bits(tokens: np.ndarray) -> bytes:
    """Parity of the set's hashes in 2^k cells, at least two cells an element."""
    cells = max(64, 1 << (2 * len(tokens) - 1).bit_length())
    odd = np.bincount((tokens & np.uint64(cells - 1)).astype(np.int64), minlength=cells) & 1
    return np.packbits(odd.astype(np.uint8), bitorder="little").tobytes()


def least_overlap(a: int, b: int, percent: int) -> int:
    """Smallest intersection size at which sets of these sizes link."""
    return -(-percent * (a + b) // (100 + percent))


def prefix_size(n: int, percent: int) -> int:
    return n - -(-percent * n // 100) + 1


# ------------------------------------------------------------------ map passes


def _describe(docs: DataFrame, n: int, naming: Naming) -> DataFrame:
    """kind 0: (row, size, k1, k2, bits) of documents; kind 1: heavy shingles of a batch."""

    def run(batches):
        for pdf in (part for whole in batches for part in slices(whole, BATCH_DOCS)):
            rows, seen = [], {}
            for row, text in zip(pdf["row"], pdf["text"]):
                tokens = shingle_set(text, n)
                if not len(tokens):
                    rows.append((0, row, 0, 0, 0, b""))
                    continue
                k1, k2 = naming(tokens), digest(tokens)[1]
                first = (k1, k2) not in seen
                seen.setdefault((k1, k2), tokens)
                rows.append((0, row, len(tokens), k1, k2, parity_bits(tokens) if first else b""))
            if seen:
                keys = np.repeat(
                    np.fromiter((k for k, _ in seen), np.int64, len(seen)), [len(t) for t in seen.values()]
                )
                tokens = np.concatenate(list(seen.values()))
                order = np.argsort(tokens, kind="stable")
                tokens, keys = tokens[order], keys[order]
                at = np.flatnonzero(np.r_[True, tokens[1:] != tokens[:-1]])
                count = np.diff(np.r_[at, len(tokens)])
                low = np.minimum.reduceat(keys, at)
                for k in np.flatnonzero(count >= HEAVY_IN_BATCH):
                    token = int(tokens[at[k]].view(np.int64))
                    rows.append((1, int(low[k]), int(count[k]), token, 0, b""))
            yield pd.DataFrame(rows, columns=["kind", "row", "size", "k1", "k2", "bits"])
        give_back()

    schema = "kind int, row long, size long, k1 long, k2 long, bits binary"
    return docs.select("row", "text").mapInPandas(run, schema)


def _canopies(docs: DataFrame, n: int, percent: int, buckets: int, heavy: list, naming: Naming) -> DataFrame:
    """Distinct (pivot, member) of all inverted lists over the sets' prefixes."""
    table = np.array([(t, c, p) for t, c, p in heavy], dtype=np.int64).reshape(-1, 3)
    tokens_h = table[:, 0].copy().view(np.uint64)
    order = np.argsort(tokens_h)
    tokens_h, pivots_h = tokens_h[order], table[order, 2]
    rank_h = np.empty(len(order), dtype=np.int64)
    rank_h[np.lexsort((tokens_h, table[order, 1]))] = np.arange(len(order))

    def deal(batches):
        for number, pdf in enumerate(part for whole in batches for part in slices(whole, 2 * BATCH_DOCS)):
            seen: set[int] = set()
            keys, toks, sizes, hp, hm = [], [], [], [], []
            for text in pdf["text"]:
                tokens = shingle_set(text, n)
                if not len(tokens):
                    continue
                key = naming(tokens)
                if key in seen:
                    continue
                seen.add(key)
                want = prefix_size(len(tokens), percent)
                if len(tokens_h):
                    at = np.minimum(np.searchsorted(tokens_h, tokens), len(tokens_h) - 1)
                    frequent = tokens_h[at] == tokens
                    light = tokens[~frequent][:want]
                    rest = want - len(light)
                    if rest > 0:
                        at = at[frequent]
                        at = at[np.argsort(rank_h[at])][:rest]
                        for p in np.unique(pivots_h[at]):
                            if p != key:
                                hp.append(p)
                                hm.append(key)
                else:
                    light = tokens[:want]
                keys.append(key)
                toks.append(light)
                sizes.append(len(light))
            if not keys:
                continue
            tok = np.concatenate(toks)
            idx = np.repeat(np.arange(len(keys), dtype=np.uint32), sizes)
            where = (tok % np.uint64(buckets)).astype(np.int64)
            order = np.argsort(where, kind="stable")
            cut = np.searchsorted(where[order], np.arange(buckets + 1))
            all_keys, out = np.array(keys, np.int64), []
            for b in range(buckets):
                own = order[cut[b] : cut[b + 1]]
                if not len(own):
                    continue
                used, local = np.unique(idx[own], return_inverse=True)
                out.append((b, tok[own].tobytes(), local.astype(np.uint32).tobytes(),
                            all_keys[used].tobytes(), b"", b""))
            if hp:
                out.append((number % buckets, b"", b"", b"", np.array(hp, np.int64).tobytes(),
                            np.array(hm, np.int64).tobytes()))
            yield pd.DataFrame(out, columns=["bucket", "tok", "idx", "cls", "hp", "hm"])
        give_back()

    def lists(pdf: pd.DataFrame) -> pd.DataFrame:
        toks, keys = [], []
        for tok, idx, cls in zip(pdf["tok"], pdf["idx"], pdf["cls"]):
            toks.append(np.frombuffer(tok, np.uint64))
            keys.append(np.frombuffer(cls, np.int64)[np.frombuffer(idx, np.uint32)])
        tok, key = np.concatenate(toks), np.concatenate(keys)
        order = np.lexsort((key, tok))
        tok, key = tok[order], key[order]
        start = np.r_[True, tok[1:] != tok[:-1]][: len(tok)]
        at = np.flatnonzero(start)
        pivot = key[at][np.cumsum(start) - 1] if len(at) else key
        other = pivot != key
        pairs = np.stack([pivot[other], key[other]], axis=1)
        more = [np.stack([np.frombuffer(a, np.int64), np.frombuffer(b, np.int64)], axis=1)
                for a, b in zip(pdf["hp"], pdf["hm"]) if a]
        pairs = np.unique(np.concatenate([pairs, *more]), axis=0)
        return pd.DataFrame(pairs, columns=["pivot", "member"])

    schema = "bucket int, tok binary, idx binary, cls binary, hp binary, hm binary"
    return (
        docs.select("text")
        .mapInPandas(deal, schema)
        .groupBy("bucket")
        .applyInPandas(lists, "pivot long, member long")
        .distinct()
    )


# ------------------------------------------------------------ inside canopies


def _fold(x: int, cells: int, to: int) -> int:
    while cells > to:
        cells //= 2
        x = (x >> cells) ^ (x & ((1 << cells) - 1))
    return x


def may_link(a: tuple[int, int, int], b: tuple[int, int, int], percent: int) -> bool:
    """(size, cells, bits) of two sets: False only if they certainly don't link."""
    least = least_overlap(a[0], b[0], percent)
    if least > min(a[0], b[0]):
        return False
    to = min(a[1], b[1])
    apart = (_fold(a[2], a[1], to) ^ _fold(b[2], b[1], to)).bit_count()
    return apart <= a[0] + b[0] - 2 * least


def medoid(info: dict[int, tuple[int, int, int]]) -> int:
    """The set nearest to a spread of the others by parity distance: of near copies, mostly
    the text they were made from, which links with all of them."""
    names = sorted(info)
    some = names[:: max(1, len(names) // MEDOID_PROBES)]

    def apart(m):
        size, cells, bits = info[m]
        total = 0
        for o in some:
            to = min(cells, info[o][1])
            total += (_fold(bits, cells, to) ^ _fold(info[o][2], info[o][1], to)).bit_count()
        return (total, m)

    return min(names, key=apart)


def _left_pairs(canopies: DataFrame, classes: DataFrame, percent: int, second: bool) -> DataFrame:
    """Pairs that a search must decide. First round: of the pivot and of the medoid with all
    (in small canopies, of all with all); second round: of members in different components
    (``component``) of larger canopies."""
    # only canopies of several blocks need their size known: few, and sent to their rows,
    # so that no canopy has to meet in one place
    large = canopies.groupBy("pivot").agg(
        F.ceil(F.count(F.lit(1)) / CANOPY_BLOCK).cast("int").alias("_blocks")
    ).filter("_blocks > 1")
    rows = canopies.join(checked_broadcast(large), "pivot", "left").withColumn("_blocks", F.coalesce("_blocks", F.lit(1)))
    own = F.pmod(F.xxhash64("member"), F.col("_blocks")).cast("int")
    pairs_of_blocks = F.explode(
        F.transform(
            F.sequence(F.lit(0), F.col("_blocks") - 1),
            lambda k: F.struct(F.least(k, F.col("_own")).alias("i"), F.greatest(k, F.col("_own")).alias("j")),
        )
    )
    members = (
        rows.filter("pivot != member").withColumn("_own", own)
        .select("pivot", "member", *(["component"] if second else []), "_own", pairs_of_blocks.alias("_b"))
    )
    heads = rows.filter("pivot = member") if second else (
        rows.select("pivot", "_blocks").distinct().withColumn("member", F.col("pivot"))
    )
    all_blocks = F.explode(
        F.flatten(
            F.transform(
                F.sequence(F.lit(0), F.col("_blocks") - 1),
                lambda i: F.transform(
                    F.sequence(i, F.col("_blocks") - 1),
                    lambda j: F.struct(i.alias("i"), j.alias("j")),
                ),
            )
        )
    )
    heads = heads.select("pivot", "member", *(["component"] if second else []), F.lit(-1).alias("_own"), all_blocks.alias("_b"))
    component = F.col("component") if second else F.lit(None).cast("long").alias("component")
    dealt = (
        members.union(heads)
        .join(classes.select(F.col("k1").alias("member"), "size", "bits"), "member")
        .select("pivot", F.col("_b.i").alias("i"), F.col("_b.j").alias("j"), "member", "_own", component, "size", "bits")
        .repartition(shuffle_partitions(canopies.sparkSession), "pivot", "i", "j")
        .sortWithinPartitions("pivot", "i", "j", "_own", "member")
    )

    def decide(key, rows):
        pivot, i, j = key
        info = {m: (size, 8 * len(bits), int.from_bytes(bits, "little")) for m, _, _, size, bits in rows}
        rest = [(m, block, c) for m, block, c, _, _ in rows if m != pivot]
        small = len(info) <= SMALL_CANOPY
        if not small and not second:
            for hub in {pivot, medoid(info)} & info.keys():
                for m in info:
                    if m != hub and may_link(info[hub], info[m], percent):
                        yield (hub, m)
            return
        everyone = rest if second else [(m, 0, None) for m in info]
        for x, (u, bu, cu) in enumerate(everyone):
            for y, by, cy in everyone[x + 1 :]:
                if second and (cu == cy or i != j and bu == by):
                    continue
                if may_link(info[u], info[y], percent):
                    yield (u, y)

    def run(batches):
        key, rows, out = None, [], []
        for pdf in batches:
            for p, i, j, m, own, c, size, bits in zip(*(pdf[x].tolist() for x in pdf.columns)):
                if (p, i, j) != key:
                    if len(rows) > 1:
                        out += decide(key, rows)
                    key, rows = (p, i, j), []
                rows.append((m, own, c, size, bits))
                if len(out) > 50_000:
                    yield pd.DataFrame(out, columns=["a", "b"])
                    out = []
        if len(rows) > 1:
            out += decide(key, rows)
        yield pd.DataFrame(out, columns=["a", "b"], dtype=np.int64)
        give_back()

    found = dealt.mapInPandas(run, "a long, b long")
    return found.select(F.least("a", "b").alias("a"), F.greatest("a", "b").alias("b")).distinct()


# ------------------------------------------------------------ T-occurrence search


def divide_skip(query: np.ndarray, members: list[np.ndarray], percent: int) -> list[int]:
    """Positions of the members that link with ``query``, by T-occurrence search.

    Inverted lists of the query's tokens over the members; the longest are kept apart.
    Merging the short ones counts occurrences; who can still reach the required overlap
    is looked up in the long lists by binary search.
    """
    sizes = np.array([len(m) for m in members], dtype=np.int64)
    tokens = np.concatenate(members)
    docs = np.repeat(np.arange(len(members)), sizes)
    order = np.argsort(tokens, kind="stable")
    tokens, docs = tokens[order], docs[order]
    lo, hi = np.searchsorted(tokens, query, "left"), np.searchsorted(tokens, query, "right")
    length = hi - lo
    need = np.maximum(-(-percent * (len(query) + sizes) // (100 + percent)), 1)
    least = int(need.min())
    longest = int(length.max(initial=0))
    apart = 0
    if longest > 1:
        apart = min(least - 1, int(least / (0.01 * math.log2(longest) + 1)))
    by_length = np.argsort(-length, kind="stable")
    long_lists = by_length[:apart][length[by_length[:apart]] > 1]
    short = np.ones(len(query), dtype=bool)
    short[long_lists] = False
    spans = [docs[a:b] for a, b in zip(lo[short], hi[short]) if b > a]
    counts = np.bincount(np.concatenate(spans), minlength=len(members)) if spans else np.zeros(len(members), np.int64)
    alive = np.flatnonzero(counts + len(long_lists) >= need)
    for k, q in enumerate(long_lists):
        if not len(alive):
            break
        postings = docs[lo[q] : hi[q]]
        at = np.minimum(np.searchsorted(postings, alive), len(postings) - 1)
        counts[alive] += postings[at] == alive
        alive = alive[counts[alive] + len(long_lists) - k - 1 >= need[alive]]
    return alive.tolist()


def _search(pairs: DataFrame, docs: DataFrame, classes: DataFrame, n: int, percent: int, naming: Naming) -> DataFrame:
    """The pairs (a, b) of classes that link.

    Texts travel, not sets: they are half the bytes. Each is read again from its class's
    first row and meets its query's block.
    """
    per = pairs.groupBy("a").agg(F.count(F.lit(1)).alias("_n")).withColumn(
        "_salts", F.ceil(F.col("_n") / QUERY_BLOCK).cast("int")
    )
    asked = pairs.join(per, "a").select(
        "a", F.pmod(F.xxhash64("b"), F.col("_salts")).cast("int").alias("salt"),
        F.col("b").alias("member"), F.lit(1).alias("role"),
    )
    queries = per.select(
        "a", F.explode(F.sequence(F.lit(0), F.col("_salts") - 1)).alias("salt"),
        F.col("a").alias("member"), F.lit(0).alias("role"),
    )
    wanted = asked.union(queries).join(
        classes.select(F.col("k1").alias("member"), "row"), "member"
    )
    dealt = (
        docs.select("row", "text").join(wanted.hint("shuffle_hash"), "row")
        .select("a", "salt", "role", "member", "text")
        .repartition(shuffle_partitions(docs.sparkSession), "a", "salt")
        .sortWithinPartitions("a", "salt", "role", "member")
    )

    def run(batches):
        key, query, names, members, out = None, None, [], [], []

        def flush():
            if query is not None and members:
                for k in divide_skip(query, members, percent):
                    out.append((key[0], names[k]))

        for pdf in batches:
            for a, salt, role, member, text in zip(*(pdf[x] for x in pdf.columns)):
                if (a, salt) != key:
                    flush()
                    key, query, names, members = (a, salt), None, [], []
                if role == 0 and query is not None or names and names[-1] == member:
                    continue
                tokens = shingle_set(text, n)
                if role == 0:
                    query = tokens
                else:
                    names.append(member)
                    members.append(tokens)
        flush()
        yield pd.DataFrame(out, columns=["a", "b"], dtype=np.int64)
        give_back()

    return dealt.mapInPandas(run, "a long, b long").distinct()


# ---------------------------------------------------------------------- operator


def classified(docs: DataFrame, n: int, percent: int, key_bits: int = 64) -> DataFrame:
    """(row, size, k1, component) of ``docs`` (row long, text string, read several times): the
    set's size, its class and the class's component; null class and component of empty sets."""
    spark = docs.sparkSession
    described = materialise(_describe(docs, n, Naming(bits=key_bits)))
    shared = (
        described.filter("kind = 0 AND size > 0").groupBy("k1")
        .agg(F.min("k2").alias("lo"), F.max("k2").alias("hi")).filter("lo <> hi").select("k1").collect()
    )  # fmt: skip  # of 64 bits: some 70 in 5 * 10^10 texts
    naming = Naming(frozenset(r["k1"] for r in shared), key_bits)
    if shared:
        described = materialise(_describe(docs, n, naming))
    rows = described.filter("kind = 0")
    classes = materialise(
        rows.filter("size > 0").groupBy("k1")
        .agg(F.min("row").alias("row"), F.max("size").alias("size"), F.max("bits").alias("bits"))
    )
    heavy = (
        described.filter("kind = 1").groupBy("k1")
        .agg(F.sum("size").alias("c"), F.min("row").alias("p"))
        .orderBy(F.desc("c"), "k1").limit(HEAVY_TABLE)
        .collect()
    )  # fmt: skip  # an order's hint of at most HEAVY_TABLE rows; it decides no result
    total = classes.agg(F.sum(F.col("size") * (100 - percent) / 100 + 1)).first()[0] or 0
    buckets = max(shuffle_partitions(spark), int(total // 2_000_000) + 1)
    canopies = materialise(
        _canopies(docs, n, percent, buckets, [(r["k1"], r["c"], r["p"]) for r in heavy], naming)
    )
    pairs = materialise(_left_pairs(canopies, classes, percent, second=False))
    links = materialise(_search(pairs, docs, classes, n, percent, naming))
    joined = materialise(connected_components(links.select(F.col("a").alias("u"), F.col("b").alias("v"))))

    named = canopies.union(canopies.select("pivot", F.col("pivot").alias("member")).distinct()).join(
        joined.withColumnRenamed("node", "member"), "member", "left"
    ).withColumn("component", F.coalesce("component", "member"))
    # a canopy is settled once its members are in one component; small ones were compared whole
    open_pivots = (
        named.groupBy("pivot").agg(F.min("component").alias("lo"), F.max("component").alias("hi"), F.count(F.lit(1)).alias("n"))
        .filter((F.col("lo") != F.col("hi")) & (F.col("n") > SMALL_CANOPY)).select("pivot")
    )
    named = materialise(named.join(checked_broadcast(materialise(open_pivots)), "pivot", "left_semi"))
    again = materialise(_left_pairs(named, classes, percent, second=True).join(pairs, ["a", "b"], "left_anti"))
    more = not again.isEmpty()
    before = joined
    if more:
        links = links.union(_search(again, docs, classes, n, percent, naming))
        joined = materialise(connected_components(links.select(F.col("a").alias("u"), F.col("b").alias("v"))))
    # written before it meets the rows: copies are many rows of a key, and only a join of two
    # plain sides is split where it is skewed
    labels = materialise(
        classes.select("k1").join(joined.withColumnRenamed("node", "k1"), "k1", "left").select(
            "k1", F.coalesce("component", "k1").alias("component")
        )
    )
    discard(canopies, pairs, named, again, before, classes, *([joined] if more else []))
    own = rows.select("row", "size", F.when(F.col("size") > 0, F.col("k1")).alias("k1"))
    return own.join(labels, "k1", "left")


def components(
    docs: DataFrame, n: int = 5, percent: int = 75, id_col: str = "doc_id", text_col: str = "text", key_bits: int = 64
) -> DataFrame:
    """doc_id, n_shingles, component_id (smallest doc_id reachable by links) of every row."""
    ship(docs.sparkSession)
    docs = docs.select(F.col(id_col).alias("doc_id"), F.col(text_col).alias("text"))
    docs = materialise(docs.withColumn("row", F.monotonically_increasing_id()))
    found = classified(docs, n, percent, key_bits).join(docs.select("row", "doc_id"), "row")
    found = materialise(found)
    smallest = materialise(
        found.filter("component IS NOT NULL").groupBy("component").agg(F.min("doc_id").alias("component_id"))
    )
    return found.join(smallest, "component", "left").select(
        "doc_id", F.col("size").alias("n_shingles"),
        F.when(F.col("component").isNull(), F.col("doc_id")).otherwise(F.col("component_id")).alias("component_id"),
    )


def keep_one(docs: DataFrame, n: int = 5, percent: int = 75, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """``docs`` with one row of every component: of the smallest id (null ids last), then
    the first. Rows without words are near duplicates of nothing and stay."""
    ship(docs.sparkSession)
    row = free_name(docs.columns, "_row")
    numbered = materialise(docs.withColumn(row, F.monotonically_increasing_id()))
    texts = numbered.select(F.col(row).alias("row"), F.col(text_col).alias("text"))
    ids = numbered.select(F.col(row).alias("row"), F.col(id_col).alias("id"))
    found = materialise(classified(texts, n, percent).filter("component IS NOT NULL").join(ids, "row"))
    kept = materialise(
        found.groupBy("component").agg(F.min(F.struct(F.col("id").isNull().alias("none"), "id", "row")).alias("_k"))
        .select("component", F.col("_k.row").alias("_keep"))
    )
    dropped = found.select("component", F.col("row").alias("_r")).join(kept, "component").filter("_r <> _keep").select(F.col("_r").alias(row))
    return numbered.join(dropped.hint("shuffle_hash"), row, "left_anti").drop(row)
