"""Best-fit packing of documents into fixed-length sequences by a grouping genetic algorithm.

Documents of equal token length are interchangeable, so the search runs on the
histogram of lengths (at most ``capacity`` entries, whatever the corpus): a gene is a
*bin pattern* (a multiset of lengths) with a multiplicity. The group-oriented crossover
injects whole well-filled bins of one parent into the other, drops what became
duplicate, and best-fits the displaced lengths. Islands are Spark tasks; after every
epoch each passes its elites to its neighbour. The winning plan is dealt to documents by
rank within their length, computed with salted windows, so nothing but the bounded
histogram and plan ever reaches the driver.

Defined results: null or empty text is one end token; a document longer than
``capacity`` is cut into full pieces and a rest, however long it is; repeated rows are packed
each on their own; pieces of equal length are interchangeable, so ties change no length of a
sequence; an empty table gives an empty result; extra columns are ignored.
"""

from __future__ import annotations

import json
import pickle
import random
import re
import struct
import zlib
from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from rewardmill.llm.common import give_back, materialise, ship

PIECES = "doc_id long, piece int, start long, length long, ids_crc32 long"
Plan = dict[tuple[int, ...], int]


# ------------------------------------------------------------------ tokenising

_ENCODERS: dict[str, "_Memo"] = {}
MEMO_CHUNKS = 300_000

#: Settings of a vocabulary whose words can be split here: the parts of its file that say how
#: text becomes words. Vocabularies with any other settings go through their own tokenizer.
KNOWN_SETTINGS = {
    "normalizer": {
        "type": "Sequence",
        "normalizers": [
            {"type": "NFC"},
            {"type": "Replace", "pattern": {"Regex": r"\s+"}, "content": " "},
            {"type": "Lowercase"},
        ],
    },
    "pre_tokenizer": {
        "type": "Sequence",
        "pretokenizers": [
            {
                "type": "Split",
                "pattern": {"Regex": r"'s|'t|'re|'ve|'m|'ll|'d|[\p{L}]+|[\p{N}]|[^\s\p{L}\p{N}]+"},
                "behavior": "Removed",
                "invert": True,
            },
            {"type": "ByteLevel", "add_prefix_space": False, "trim_offsets": True, "use_regex": False},
        ],
    },
    "post_processor": None,
}


def splits_at_spaces(settings: dict) -> bool:
    """Whether a vocabulary's settings are the known ones, and its added tokens are marked by
    "<|": then a text's ids are those of its space-separated chunks."""
    added = settings.get("added_tokens") or []
    plain = all(t["content"].startswith("<|") and not t["lstrip"] and not t["rstrip"] for t in added)
    return plain and {k: settings.get(k) for k in KNOWN_SETTINGS} == KNOWN_SETTINGS

#: The vocabulary's word pattern, for chunks of printable ASCII and Latin-1 letters only:
#: there NFC changes nothing and lower-casing goes letter by letter.
_PLAIN = re.compile("[\x21-\x7e\xc0-\xff]*\\Z").match
_WORDS = re.compile(r"'s|'t|'re|'ve|'m|'ll|'d|[^\W\d_]+|[0-9]|(?:[^\s\w]|_)+").findall


def _byte_letters() -> dict[int, str]:
    """Byte-level alphabet: printable bytes stand for themselves, others from U+0100 on."""
    plain = [*range(0x21, 0x7F), *range(0xA1, 0xAD), *range(0xAE, 0x100)]
    rest = [b for b in range(256) if b not in plain]
    return {b: chr(b) for b in plain} | {b: chr(256 + k) for k, b in enumerate(rest)}


class _Memo(dict):
    """Chunk of text without spaces -> its token ids, as little-endian 32-bit bytes.

    Ordinary chunks are split into words here and go to the vocabulary's merge model
    word by word, each remembered; any other chunk goes through the whole tokenizer.
    """

    def __init__(self, path: str):
        import os

        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        from tokenizers import Tokenizer

        self.whole = Tokenizer.from_file(path)
        self.model = self.whole.model
        self.by_chunks = splits_at_spaces(json.loads(self.whole.to_str()))
        self.words: dict[str, bytes] = {}
        self.letters = _byte_letters()

    def __missing__(self, chunk: str) -> bytes:
        if "<|" in chunk or not _PLAIN(chunk):
            ids = self.whole.encode(chunk, add_special_tokens=False).ids
            out = np.array(ids, dtype="<u4").tobytes()
        else:
            out = b"".join(map(self.word, _WORDS(chunk.lower())))
        if len(self) < MEMO_CHUNKS:
            self[chunk] = out
        return out

    def word(self, word: str) -> bytes:
        out = self.words.get(word)
        if out is None:
            text = word
            if not word.isascii():
                text = word.encode().decode("latin-1").translate(self.letters)
            out = struct.pack(f"<{len(t)}I", *t) if (
                t := [x.id for x in self.model.tokenize(text)]
            ) else b""
            if len(self.words) < MEMO_CHUNKS:
                self.words[word] = out
        return out


def encode_texts(texts: list[str], path: str) -> list[bytes]:
    """Token ids of each text as little-endian unsigned 32-bit bytes.

    Where the tokenizer drops white space and never joins across it, a text's ids are those
    of its space-separated chunks in order, and the commonest chunks are remembered; any
    other vocabulary reads whole texts.
    """
    if path not in _ENCODERS:
        _ENCODERS[path] = _Memo(path)
    memo = _ENCODERS[path]
    if not memo.by_chunks:
        return [np.array(memo.whole.encode(t, add_special_tokens=False).ids, dtype="<u4").tobytes() for t in texts]
    get = memo.__getitem__
    return [b"".join(map(get, t.replace("\n", " ").split(" "))) for t in texts]


def tokenised_pieces(
    docs: DataFrame, tokenizer_path: str, capacity: int, end_id: int, id_col: str, text_col: str
) -> DataFrame:
    """One row per piece of at most ``capacity`` tokens of every document."""
    ship(docs.sparkSession)
    end = np.array([end_id], dtype="<u4").tobytes()
    step = 4 * capacity

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for pdf in batches:
            rows = []
            texts = [t if isinstance(t, str) else "" for t in pdf["text"]]
            for doc, ids in zip(pdf["id"], encode_texts(texts, tokenizer_path)):
                ids += end
                for k, at in enumerate(range(0, len(ids), step)):
                    cut = ids[at : at + step]
                    rows.append((doc, k, at // 4, len(cut) // 4, zlib.crc32(cut)))
            yield pd.DataFrame(rows, columns=["doc_id", "piece", "start", "length", "ids_crc32"])
        give_back()

    return docs.select(F.col(id_col).alias("id"), F.col(text_col).alias("text")).mapInPandas(
        run, PIECES
    )


# ---------------------------------------------------------- search on a histogram


def lower_bound(hist: dict[int, int], capacity: int) -> int:
    """No packing has fewer bins: total volume, and lengths over half can't share."""
    volume = -(-sum(n * c for n, c in hist.items()) // capacity)
    return max(volume, sum(c for n, c in hist.items() if 2 * n > capacity))


class _Bins:
    """Open bins grouped by (room, pattern); bulk best fit of many equal lengths at once."""

    def __init__(self, capacity: int):
        self.capacity, self.by_room, self.mask = capacity, {}, 0

    def add(self, pattern: tuple[int, ...], room: int, n: int) -> None:
        group = self.by_room.setdefault(room, {})
        group[pattern] = group.get(pattern, 0) + n
        self.mask |= 1 << room

    def place(self, length: int, n: int) -> None:
        while n:
            fits = self.mask >> length
            if not fits:
                per = min(self.capacity // length, n)
                self.add((length,) * per, self.capacity - per * length, n // per)
                n %= per
                continue
            room = length + (fits & -fits).bit_length() - 1
            group = self.by_room[room]
            pattern, have = group.popitem()
            per = min(room // length, n)
            used = min(have, n // per)
            if have > used:
                group[pattern] = have - used
            if not group:
                del self.by_room[room]
                self.mask &= ~(1 << room)
            self.add(pattern + (length,) * per, room - per * length, used)
            n -= used * per

    def plan(self) -> Plan:
        out: Plan = {}
        for group in self.by_room.values():
            for pattern, n in group.items():
                key = tuple(sorted(pattern, reverse=True))
                out[key] = out.get(key, 0) + n
        return out


def best_fit(hist: dict[int, int], capacity: int, order: list[tuple[int, int]] | None = None) -> Plan:
    """Best fit of (length, count) runs in the given order (decreasing by default)."""
    bins = _Bins(capacity)
    for length, n in order or sorted(hist.items(), reverse=True):
        bins.place(length, n)
    return bins.plan()


def fitness(plan: Plan, capacity: int) -> tuple[int, float]:
    """Fewer bins first; then fuller ones (sum of squared fill)."""
    fill = sum(n * (sum(p) / capacity) ** 2 for p, n in plan.items())
    return (sum(plan.values()), -fill)


def _take(plan_rows, left: dict[int, int], into: Plan, share) -> None:
    """Move bins of ``plan_rows`` to ``into`` as far as their items are still unplaced."""
    for pattern, n in plan_rows:
        need: dict[int, int] = {}
        for x in pattern:
            need[x] = need.get(x, 0) + 1
        n = min(share(n), min(left.get(x, 0) // k for x, k in need.items()))
        if n > 0:
            into[pattern] = into.get(pattern, 0) + n
            for x, k in need.items():
                left[x] -= n * k


def crossover(a: Plan, b: Plan, hist: dict[int, int], capacity: int, rng: random.Random) -> Plan:
    """Inject well-filled bins of ``b`` into ``a``, drop duplicates, best-fit the displaced."""
    left, kept = dict(hist), {}
    ranked = sorted(b.items(), key=lambda x: (-sum(x[0]), x[0]))
    best = ranked[: max(1, len(ranked) * 3 // 4)]
    chosen = [x for x in best if rng.random() < 0.5] or best[:1]
    _take(chosen, left, kept, lambda n: n if n < 3 else rng.randint(n // 2, n))
    _take(sorted(a.items(), key=lambda x: (-sum(x[0]), x[0])), left, kept, lambda n: n)
    return _refit(kept, left, capacity)


def mutate(a: Plan, hist: dict[int, int], capacity: int, rng: random.Random) -> Plan:
    """Break up the emptiest bins and some random ones, and best-fit their items again."""
    left, kept = dict(hist), {}
    ranked = sorted(a.items(), key=lambda x: (-sum(x[0]), x[0]))
    keep = [x for x in ranked[: max(1, len(ranked) * 9 // 10)] if rng.random() < 0.9]
    _take(keep, left, kept, lambda n: n)
    return _refit(kept, left, capacity)


def _refit(kept: Plan, left: dict[int, int], capacity: int) -> Plan:
    bins = _Bins(capacity)
    for pattern, n in kept.items():
        bins.add(pattern, capacity - sum(pattern), n)
    for length in sorted((x for x, n in left.items() if n), reverse=True):
        bins.place(length, left[length])
    return bins.plan()


def seed_population(hist: dict[int, int], capacity: int, size: int, seed: int) -> list[Plan]:
    """Best fit decreasing, and best fit of randomly disturbed decreasing orders."""
    rng = random.Random(seed)
    out = [best_fit(hist, capacity)]
    while len(out) < size:
        spread = rng.choice((0.05, 0.2, 0.5))
        order = sorted(hist.items(), key=lambda x: -x[0] * (1 + spread * rng.random()))
        out.append(best_fit(hist, capacity, order))
    return out


def evolve(
    population: list[Plan], hist: dict[int, int], capacity: int, generations: int, seed: int
) -> list[Plan]:
    """Steady-state evolution of one island; best first."""
    rng, bound = random.Random(seed), lower_bound(hist, capacity)
    pool = sorted(population, key=lambda p: fitness(p, capacity))
    for _ in range(generations):
        a, b = (pool[min(rng.randrange(len(pool)) for _ in range(2))] for _ in range(2))
        child = crossover(a, b, hist, capacity, rng)
        if rng.random() < 0.3:
            child = mutate(child, hist, capacity, rng)
        pool = sorted([*pool[:-1], min(pool[-1], child, key=lambda p: fitness(p, capacity))],
                      key=lambda p: fitness(p, capacity))
        if fitness(pool[0], capacity)[0] <= bound:
            break
    return pool


def search_islands(
    spark: SparkSession, hist: dict[int, int], capacity: int, islands: int, population: int,
    generations: int, epochs: int, seed: int,
) -> Plan:
    """Evolve islands as Spark tasks; elites migrate round a ring between epochs.

    What travels is plans over the histogram: bounded by ``capacity``, not by the corpus.
    Stops early once a plan meets the lower bound, for then none is better.
    """
    bound = lower_bound(hist, capacity)
    pools: dict[int, list[bytes]] = {i: [] for i in range(islands)}
    best: Plan | None = None
    for epoch in range(epochs):
        rows = [(i, pickle.dumps(pools[i])) for i in range(islands)]
        state = spark.createDataFrame(rows, "island int, pool binary").repartition(
            islands, "island"
        )

        def run(batches, epoch=epoch):
            for pdf in batches:
                out = []
                for island, raw in zip(pdf["island"], pdf["pool"]):
                    mine = [pickle.loads(x) for x in pickle.loads(raw)]
                    own = seed * 7919 + int(island) * 104729 + epoch
                    if not mine:
                        mine = seed_population(hist, capacity, population, own)
                    mine = evolve(mine, hist, capacity, generations, own)
                    out.append((island, pickle.dumps([pickle.dumps(p) for p in mine])))
                yield pd.DataFrame(out, columns=["island", "pool"])

        done = {r["island"]: pickle.loads(r["pool"]) for r in
                state.mapInPandas(run, "island int, pool binary").collect()}
        leaders = {i: pickle.loads(done[i][0]) for i in done}
        first = min(leaders, key=lambda i: (fitness(leaders[i], capacity), i))
        if best is None or fitness(leaders[first], capacity) < fitness(best, capacity):
            best = leaders[first]
        if sum(best.values()) <= bound:
            break
        elite = max(1, population // 4)
        pools = {i: done[(i - 1) % islands][:elite] + done[i][:-elite] for i in done}
    return best or {}


# ------------------------------------------------------------------- dealing out


def plan_table(plan: Plan) -> dict[str, np.ndarray]:
    """Slots of a plan as ranges of ranks within a length, sorted by (length, first rank)."""
    rows, base, upto = [], 0, {}
    for pattern in sorted(plan, reverse=True):
        n, before, at = plan[pattern], 0, 0
        while at < len(pattern):
            length = pattern[at]
            per = pattern.count(length)
            first = upto.get(length, 0)
            rows.append((length, first, per, base, before))
            upto[length] = first + per * n
            before += per * length
            at += per
        base += n
    rows.sort()
    t = np.array(rows, dtype=np.int64).reshape(-1, 5)
    return dict(zip(("length", "first", "per", "base", "before"), t.T))


def deal(pieces: DataFrame, plan: Plan, rows: int) -> DataFrame:
    """Give every piece its sequence and offset: rank within its length meets the plan.

    ``_at`` numbers the rows of the written table: copies of a document spread over salts.
    """
    salts = int(min(4096, max(16, rows // 1_000_000)))
    salted = pieces.withColumn("_salt", F.pmod(F.xxhash64("_at"), F.lit(salts)))
    counts = salted.groupBy("length", "_salt").agg(F.count(F.lit(1)).alias("_n"))
    upto = Window.partitionBy("length").orderBy("_salt").rowsBetween(
        Window.unboundedPreceding, -1
    )
    offsets = counts.select(
        "length", "_salt", F.coalesce(F.sum("_n").over(upto), F.lit(0)).alias("_before")
    )
    inside = Window.partitionBy("length", "_salt").orderBy("_at")
    ranked = (
        salted.withColumn("_row", F.row_number().over(inside) - 1)
        .join(offsets, ["length", "_salt"])
        .select(*(c for c in pieces.columns if c != "_at"), (F.col("_before") + F.col("_row")).alias("_rank"))
    )
    table = plan_table(plan)

    def run(batches):
        heads, head_at = np.unique(table["length"], return_index=True)
        tails = np.append(head_at[1:], len(table["length"]))
        for pdf in batches:
            length, rank = pdf["length"].to_numpy(), pdf.pop("_rank").to_numpy()
            row = np.empty(len(pdf), dtype=np.int64)
            for x in np.unique(length):
                k = np.searchsorted(heads, x)
                lo, hi = head_at[k], tails[k]
                own = length == x
                row[own] = lo + np.searchsorted(table["first"][lo:hi], rank[own], "right") - 1
            place = rank - table["first"][row]
            pdf["sequence_id"] = table["base"][row] + place // table["per"][row]
            pdf["offset"] = table["before"][row] + place % table["per"][row] * length
            yield pdf

    return ranked.mapInPandas(run, PIECES + ", sequence_id long, offset long")


def pack(
    docs: DataFrame, tokenizer_path: str, capacity: int = 4096, end_id: int = 1, islands: int = 4,
    population: int = 6, generations: int = 20, epochs: int = 3, seed: int = 17,
    id_col: str = "doc_id", text_col: str = "text",
) -> DataFrame:
    """Pieces of all documents with sequence_id and offset (see module docstring)."""
    spark = docs.sparkSession
    cut = tokenised_pieces(docs, tokenizer_path, capacity, end_id, id_col, text_col)
    pieces = materialise(cut.withColumn("_at", F.monotonically_increasing_id()))
    hist = {r["length"]: r["n"] for r in
            pieces.groupBy("length").agg(F.count(F.lit(1)).alias("n")).collect()}
    if not hist:
        return spark.createDataFrame([], PIECES + ", sequence_id long, offset long")
    plan = search_islands(spark, hist, capacity, islands, population, generations, epochs, seed)
    return deal(pieces, plan, sum(hist.values()))
