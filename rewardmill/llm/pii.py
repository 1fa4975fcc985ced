"""Personal data: base patterns plus bootstrapped contextual extraction.

Base kinds (email, ip, card, phone) are found by fixed patterns with checks. Their spans
are *seeds*: the one and the two tokens left of a seed on its line are its lexical patterns
(of a token longer than ``TOKEN_TAIL`` characters, its end: everywhere alike, so that
patterns stay words and not whole blobs). Spark then scores the
bipartite graph of patterns and instances iteratively: a pattern is worth the summed
worth of the instances it picks out over all its occurrences in the corpus (damped for
rare ones), so an everyday word before an address is worth nothing; an unseen instance
is worth the best of its patterns; seeds stay at one. Only tokens that look like identifiers (letters
mixed with digits, an @, or a long run of digits) can be instances. Patterns of high
confidence and support extract every identifier-like token behind them, as spans of
kind ``context``; base spans always stay, and a span that overlaps one is not added.

Pattern and instance statistics are pre-aggregated counts over all documents, kept as
tables joined by pattern. The driver sees hashes of the candidates, and all accepted
patterns, which go to every worker; neither is cut.

Defined results: null text is empty and has no spans; texts are read whole, in time linear
in their length (one document is in memory at a time beside its Arrow batch); repeated rows
are searched each; patterns of equal score are all accepted, so ties decide nothing; an empty
table gives an empty result; ``redact`` keeps every column, whatever it is called, and
replaces the text column alone; ``extract`` ignores extra columns.
"""

from __future__ import annotations

import hashlib
import re
import zlib
from bisect import bisect_left

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from rewardmill.llm.common import discard, give_back, materialise, ship, slices

BASE_KINDS = ("email", "ip", "card", "phone")

#: Fixed by the contract of the base kinds.
_LOCAL = frozenset("ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789._%+-")
_EMAIL = re.compile(r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+")
#: A match can only begin with a run of digits and takes runs whole; said so, it is linear.
_IP = re.compile(r"(?<![0-9])[0-9]++(\.[0-9]++)(\.[0-9]++)(\.[0-9]++)")
_CARD = re.compile(r"[0-9]([\x20-]?[0-9])+")
_PHONE = re.compile(r"\+[0-9][\x20().0-9-]+[0-9]")

_IDENTIFIER = re.compile(r"[\w@.+-]{5,}")
_DIGITS = re.compile(r"[0-9]")
#: A place inside a token where an identifier may begin.
_INSIDE = re.compile(r"[^\w\s@.+-](?=[\w@.+-])")
_OPENING = "\"'([{<"
_WHITE = re.compile(r"\s")
#: Characters of a token that its pattern keeps, from its end.
TOKEN_TAIL = 40
#: Documents whose counts a worker holds at once.
BATCH_DOCS = 2_000


def luhn(digits: str) -> bool:
    total = 0
    for k, c in enumerate(reversed(digits)):
        d = ord(c) - 48
        if k % 2:
            d = 2 * d - 9 * (d > 4)
        total += d
    return total % 10 == 0


def base_spans(text: str) -> list[tuple[str, int, int]]:
    """(kind, start, end) of the base kinds in code points, by kind, then start."""
    out = []
    at, done = text.find("@"), 0
    while at >= 0:
        start = at
        while start > done and text[start - 1] in _LOCAL:
            start -= 1
        if start < at and (m := _EMAIL.match(text, start)):
            out.append(("email", start, m.end()))
            done = m.end()
        at = text.find("@", max(at + 1, done))
    if not _DIGITS.search(text):
        return out
    for m in _IP.finditer(text):
        if all(len(p.lstrip("0")) < 4 and int(p.lstrip("0") or 0) <= 255 for p in m.group().split(".")):
            out.append(("ip", m.start(), m.end()))
    for m in _CARD.finditer(text):
        digits = m.group().replace(" ", "").replace("-", "")
        if 13 <= len(digits) <= 19 and luhn(digits):
            out.append(("card", m.start(), m.end()))
    if "+" in text:
        for m in _PHONE.finditer(text):
            if 9 <= sum(c.isdigit() for c in m.group()) <= 15:
                out.append(("phone", m.start(), m.end()))
    return out


class Left:
    """Lexical patterns of positions in a text: the one and the two tokens left of them on
    their line, so that a pattern names a context, not a value.

    Positions of white space are listed once a text and searched by bisection.
    """

    def __init__(self, text: str):
        self.text, self.white = text, None

    def token_before(self, at: int) -> tuple[int, int] | None:
        """Span of the last token (or part of one) that ends at ``at`` or before, on its line."""
        if self.white is None:
            self.white = [m.start() for m in _WHITE.finditer(self.text)]
        k = bisect_left(self.white, at)
        while k and self.white[k - 1] == at - 1:
            if self.text[at - 1] == "\n":
                return None
            at, k = at - 1, k - 1
        start = self.white[k - 1] + 1 if k else 0
        return (start, at) if start < at else None

    def patterns(self, at: int) -> list[str]:
        while at and self.text[at - 1] in _OPENING:
            at -= 1
        last = self.token_before(at)
        if last is None:
            return []
        first, one = self.token_before(last[0]), self.shaped(last)
        return [one, f"{self.shaped(first)} {one}"] if first else [one]

    def shaped(self, span: tuple[int, int]) -> str:
        start, end = span
        return _DIGITS.sub("0", self.text[max(start, end - TOKEN_TAIL) : end].lower()[-TOKEN_TAIL:])


def patterns_before(text: str, start: int) -> list[str]:
    return Left(text).patterns(start)


def contexts(line: str) -> list[tuple[str, str]]:
    """(one-token, two-token) patterns of all positions of a lower-case line where something
    may follow: behind every token and, as in key=value, inside it ("" for none)."""
    if _DIGITS.search(line):
        line = _DIGITS.sub("0", line)
    words, out, before = line.split(), [], ""
    inside = _INSIDE.search(line) is not None
    for w in words:
        heads = [w[-TOKEN_TAIL:]]
        if inside and not w.isalnum():
            for m in _INSIDE.finditer(w):
                end = m.end()
                while end and w[end - 1] in _OPENING:
                    end -= 1
                if end:
                    heads.append(w[max(0, end - TOKEN_TAIL) : end])
        out += [(h, f"{before} {h}" if before else "") for h in heads]
        before = heads[0]
    return out


def identifiers(text: str, taken: list[tuple[int, int]]) -> list[tuple[int, int]]:
    """Spans of identifier-like tokens that don't overlap ``taken``."""
    if not _DIGITS.search(text) and "@" not in text:
        return []
    out, busy, upto = [], [], 0
    for a, b in sorted(taken):  # spans of different kinds may overlap: as disjoint ones
        if busy and a < busy[-1][1]:
            busy[-1] = (busy[-1][0], max(b, busy[-1][1]))
        else:
            busy.append((a, b))
    for m in _IDENTIFIER.finditer(text):
        s, e = m.span()
        while e > s and text[e - 1] in ".-+":
            e -= 1
        token = text[s:e]
        digits = len(_DIGITS.findall(token))
        mixed = digits and any(c.isalpha() for c in token)
        if e - s < 5 or not (mixed or digits >= 7 or "@" in token):
            continue
        while upto < len(busy) and busy[upto][1] <= s:
            upto += 1
        if upto == len(busy) or busy[upto][0] >= e:
            out.append((s, e))
    return out


def _occurrences(docs: DataFrame, text_col: str) -> DataFrame:
    """(pattern, instance, seed) with counts: who stands behind which pattern, pre-aggregated."""

    def run(batches):
        for pdf in (part for whole in batches for part in slices(whole, BATCH_DOCS)):
            seen: dict[tuple[str, str, int], int] = {}
            for text in pdf["text"]:
                if not text:
                    continue
                spans, left = base_spans(text), Left(text)
                taken = [(s, e) for _, s, e in spans]
                for seed, (s, e) in [*((1, x) for x in taken), *((0, x) for x in identifiers(text, taken))]:
                    name = hashlib.blake2b(text[s:e].lower().encode("utf-8", "surrogatepass"), digest_size=12).hexdigest()
                    for p in left.patterns(s):
                        key = (p, name, seed)
                        seen[key] = seen.get(key, 0) + 1
            if seen:
                yield pd.DataFrame(
                    [(*k, n) for k, n in seen.items()], columns=["pattern", "instance", "seed", "n"]
                )
        give_back()

    return (
        docs.select(F.col(text_col).alias("text"))
        .mapInPandas(run, "pattern string, instance string, seed int, n long")
        .groupBy("pattern", "instance").agg(F.max("seed").alias("seed"), F.sum("n").alias("n"))
    )


def _filter(candidates: DataFrame, n: int) -> np.ndarray:
    """Bitmap of the candidates' hashes, some 32 bits for each: what misses it is none."""
    bits = 1 << min(31, max(16, (32 * n).bit_length()))
    at = candidates.select(
        F.pmod(F.crc32(F.col("pattern").cast("binary")), F.lit(bits)).alias("at")
    ).distinct().toPandas()["at"].to_numpy(np.int64)
    bitmap = np.zeros(bits >> 3, np.uint8)
    np.bitwise_or.at(bitmap, at >> 3, (1 << (at & 7)).astype(np.uint8))
    return bitmap


def _totals(docs: DataFrame, candidates: DataFrame, n: int, text_col: str) -> DataFrame:
    """(pattern, total) of all ``n`` candidates: how often each stands in the whole corpus,
    whatever follows; null where it was never read.

    Workers count what passes a bitmap of hashes; the join leaves the candidates themselves.
    A two-token candidate's last token is a candidate too: all its instances stand behind it.
    """
    bitmap = _filter(candidates, n).tobytes()
    mask = 8 * len(bitmap) - 1

    def maybe(p: str) -> bool:
        at = zlib.crc32(p.encode("utf-8", "surrogatepass")) & mask
        return bool(bitmap[at >> 3] >> (at & 7) & 1)

    def run(batches):
        for pdf in (part for whole in batches for part in slices(whole, BATCH_DOCS)):
            n: dict[str, int] = {}
            known: dict[str, bool] = {}
            for text in pdf["text"]:
                for line in (text or "").lower().split("\n"):
                    for one, two in contexts(line):
                        if (hit := known.get(one)) is None:
                            hit = known[one] = maybe(one)
                        if hit:
                            n[one] = n.get(one, 0) + 1
                            if two and (two in n or maybe(two)):
                                n[two] = n.get(two, 0) + 1
            yield pd.DataFrame(list(n.items()), columns=["pattern", "total"])
        give_back()

    counted = (
        docs.select(F.col(text_col).alias("text")).mapInPandas(run, "pattern string, total long")
        .groupBy("pattern").agg(F.sum("total").alias("total"))
    )
    return candidates.join(counted, "pattern", "left")


def learn_patterns(
    docs: DataFrame, rounds: int = 3, least_instances: int = 5, least_score: float = 0.55,
    prior: float = 4.0, seed_words: tuple[str, ...] = ("token", "password", "secret", "key", "ssn", "passport", "iban"),
    text_col: str = "text",
) -> dict[str, float]:
    """Accepted patterns and their scores, after ``rounds`` over the pattern-instance graph.

    ``seed_words`` name contexts known to announce identifiers; instances behind them
    count as seeds like the base kinds, and induce further patterns in the same way.
    """
    ship(docs.sparkSession)
    made = [materialise(_occurrences(docs, text_col))]
    edges = made[0]
    named = F.lit(False)
    for w in seed_words:
        named = named | F.col("pattern").rlike(rf"(^|[\s\"'_-])({w})s?\W*( ?[=:]+)?$")
    edges = edges.withColumn("start", F.when(named | (F.col("seed") == 1), 1.0).otherwise(0.0))
    worth = edges.groupBy("instance").agg(F.max("start").alias("worth"), F.max("start").alias("start"))
    candidates = materialise(
        edges.groupBy("pattern").agg(F.count(F.lit(1)).alias("instances"))
        .filter(F.col("instances") >= least_instances).select("pattern")
    )
    n = candidates.count()
    if not n:
        discard(edges, candidates)
        return {}
    totals = materialise(_totals(docs, candidates, n, text_col))
    made += [candidates, totals]
    scored = None
    for _ in range(rounds):
        scored = materialise(
            edges.join(worth.select("instance", "worth"), "instance").groupBy("pattern").agg(
                F.sum(F.col("worth") * F.col("n")).alias("mass"),
                F.sum("n").alias("seen"), F.count(F.lit(1)).alias("instances"),
            ).join(totals, "pattern")
            .select("pattern", "instances", (F.col("mass") / (F.greatest("total", "seen") + F.lit(prior))).alias("score"))
        )
        worth = materialise(
            edges.join(scored.select("pattern", "score"), "pattern", "left").groupBy("instance").agg(
                F.max("start").alias("start"),
                F.greatest(F.max("start"), F.coalesce(F.max("score"), F.lit(0.0))).alias("worth"),
            )
        )
        made += [scored, worth]
    # a pattern must pick out unseen identifiers too, or it adds nothing
    unseen = edges.filter("seed = 0").select("pattern").distinct()
    rows = (
        scored.filter((F.col("instances") >= least_instances) & (F.col("score") >= least_score))
        .join(unseen, "pattern", "left_semi")
        .orderBy(F.desc("score"), F.desc("instances"), "pattern")
        .collect()
    )
    discard(*made)
    return {r["pattern"]: r["score"] for r in rows}


def find_spans(text: str | None, patterns: dict[str, float]) -> tuple[list, list]:
    """(base spans, spans the patterns add) of a text."""
    if not text:
        return [], []
    base = base_spans(text)
    if not patterns:
        return base, []
    left = Left(text)
    more = [("context", s, e) for s, e in identifiers(text, [(s, e) for _, s, e in base])
            if any(p in patterns for p in left.patterns(s))]
    return base, more


def joined(spans: list[tuple[str, int, int]]) -> str:
    return ",".join(f"{k}:{s}:{e}" for k, s, e in spans)


def extract(docs: DataFrame, patterns: dict[str, float], id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Counts of base kinds, digest of base spans, and all spans of every document."""
    ship(docs.sparkSession)
    counts = ", ".join(f"n_{k} long" for k in BASE_KINDS)

    def run(batches):
        for pdf in (part for whole in batches for part in slices(whole, BATCH_DOCS)):
            out = []
            for doc, text in zip(pdf["id"], pdf["text"]):
                base, more = find_spans(text, patterns)
                kinds = [k for k, _, _ in base]
                out.append((doc, *(kinds.count(k) for k in BASE_KINDS),
                            hashlib.sha256(joined(base).encode()).hexdigest(),
                            joined([*base, *more]), len(more)))
            frame = pd.DataFrame(out, columns=["doc_id", *(f"n_{k}" for k in BASE_KINDS), "base_sha256", "spans", "n_context"])
            frame["doc_id"] = frame["doc_id"].astype("Int64")
            yield frame
        give_back()

    return docs.select(F.col(id_col).alias("id"), F.col(text_col).alias("text")).mapInPandas(
        run, f"doc_id long, {counts}, base_sha256 string, spans string, n_context long"
    )


def redacted(text: str, spans: list[tuple[str, int, int]]) -> str:
    """``text`` with every span replaced by [KIND]; overlapping spans become one."""
    out, at = [], 0
    for kind, s, e in sorted(spans, key=lambda x: (x[1], -x[2])):
        if s >= at:
            out += [text[at:s], f"[{kind.upper()}]"]
        at = max(at, e)
    return "".join([*out, text[at:]])


def redact(docs: DataFrame, text_col: str = "text", **learning) -> DataFrame:
    """``docs`` with all personal data found in ``text_col`` replaced by its kind."""
    patterns = learn_patterns(docs, text_col=text_col, **learning)

    @F.pandas_udf("string")
    def clean(texts: pd.Series) -> pd.Series:
        out = []
        for t in texts:
            base, more = find_spans(t, patterns)
            out.append(redacted(t, [*base, *more]) if base or more else t)
        return pd.Series(out, dtype=object)

    return docs.withColumn(text_col, clean(F.col(text_col)))
