"""License scan in DataFrame operations: MinHash bands retrieve templates, containment verifies.

Texts and templates are reduced to lower-case words of ASCII letters and digits, words to
64-bit hashes, and these to hashes of ``n``-word shingles. A text is covered by overlapping
windows of ``WINDOW`` = 8 shingles, one every 4, so that any run of five shingles lies in
one of them whole; and by windows of a single shingle. A template's shingles are cut into
overlapping *segments* of five (four if it has no more); one of fewer shingles has segments
of one.

Every window is sketched by ``bands`` MinHash bands of one row each, and so is every
segment; windows retrieve templates by an equi-join of band values. Nothing is looked up
before that, no text is left out. A segment that stands unaltered in a window has Jaccard
similarity of at least 4/8 with it and is missed with probability at most (1/2)^bands,
1.5e-5 for 16; with one of its five shingles altered it has 4/9 and is missed with 8.2e-5.
Windows of one shingle equal their segments, so one band never misses them. A template is
missed only if all its segments are, and the more it has the less one alteration matters.

What the bands retrieve is decided exactly: the share of the template's distinct shingles
that the whole document contains must reach ``least``.

Blocks of four shingles are sketched once; windows are minima of neighbouring blocks. Long
texts are sketched in parts of ``PART`` shingles that overlap by half a window. Templates, of
any number, are one table: below ``SMALL_ROWS`` band rows it is broadcast, above that joined
by a shuffle; the same holds for the retrieved pairs. Texts never shuffle below that bound.

Defined results: null or empty texts match nothing; a template of fewer than ``n`` words is
one shingle of all its words; a template without words is refused; a text's matches are
found whole however long it is (memory: some 100 bytes a word of the text in hand); equal
rows match alike, each once a template; rows with a null or a repeated id are scanned each;
two templates may match the same words, there are no ties to break; an empty table gives an
empty result; extra columns are ignored, whatever they are called.
"""

from __future__ import annotations

import re

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from rewardmill.llm.common import checked_broadcast, materialise
from rewardmill.llm.notices import NOTICES

BLOCK = 4
WINDOW = 2 * BLOCK
LONGEST_SEGMENT = BLOCK + 1
PART = 512


def template_words(text: str) -> list[str]:
    return re.findall("[a-z0-9]+", text.lower())


def template_shingles(words: list[str], n: int) -> list[str]:
    size = min(n, len(words))
    return list(dict.fromkeys(" ".join(words[k : k + size]) for k in range(len(words) - size + 1)))


def segments(shingles: list[str]) -> list[list[str]]:
    """Evenly spread runs of ``LONGEST_SEGMENT`` shingles that cover all; single ones of less
    than ``BLOCK``."""
    if len(shingles) < BLOCK:
        return [[s] for s in shingles]
    size = min(LONGEST_SEGMENT, len(shingles))
    parts = -(-len(shingles) // size)
    starts = [k * (len(shingles) - size) // max(1, parts - 1) for k in range(parts)]
    return [shingles[a : a + size] for a in starts]


def text_words(text: Column) -> Column:
    """Lower-case ASCII words of a text."""
    return F.array_remove(F.split(F.lower(F.coalesce(text, F.lit(""))), "[^a-z0-9]+"), "")


def _let(value: Column, use) -> Column:
    """``use(value)`` with ``value`` computed once."""
    return F.get(F.transform(F.array(value), use), F.lit(0))


def shingle_hashes(words: Column, span: int) -> Column:
    """Hashes of all runs of ``span`` words, in order."""

    def runs(hashed):
        starts = F.when(F.size(hashed) >= span, F.sequence(F.lit(0), F.size(hashed) - span))
        runs_ = F.transform(starts, lambda p: F.xxhash64(*(F.get(hashed, p + k) for k in range(span))))
        return F.coalesce(runs_, F.array().cast("array<bigint>"))

    return _let(F.transform(words, lambda w: F.xxhash64(w)), runs)


def _signature(hashes: Column, bands: int) -> Column:
    """One MinHash a band: the smallest of the hashes, hashed again with the band's number."""
    return F.transform(
        F.sequence(F.lit(0), F.lit(bands - 1)),
        lambda b: F.array_min(F.transform(hashes, lambda h: F.xxhash64(h, b))),
    )


def window_values(hashes: Column, bands: int, single: bool, wide: bool) -> Column:
    """Band values of all windows over (not empty) ``hashes``."""
    blocks = F.transform(
        F.sequence(F.lit(0), F.floor((F.size(hashes) - 1) / BLOCK).cast("int")),
        lambda k: _let(F.slice(hashes, k * BLOCK + 1, BLOCK), lambda block: _signature(block, bands)),
    )

    def windows(sketches: Column) -> Column:
        both = lambda k: F.zip_with(
            F.get(sketches, k), F.coalesce(F.get(sketches, k + 1), F.get(sketches, k)), lambda a, b: F.least(a, b)
        )
        return F.flatten(F.transform(F.sequence(F.lit(0), F.size(sketches) - 1), both))

    values = [F.transform(hashes, lambda h: F.xxhash64(h, F.lit(0)))] if single else []
    if wide:
        values.append(_let(blocks, windows))
    return F.concat(*values) if len(values) > 1 else values[0]


def scan(
    docs: DataFrame, templates: dict[str, str] | None = None, n: int = 5, bands: int = 16,
    least: float = 0.8, id_col: str = "doc_id", text_col: str = "text",
) -> DataFrame:
    """(doc_id, license, matched, shingles, containment) of every template found in a text."""
    spark: SparkSession = docs.sparkSession
    templates = NOTICES if templates is None else templates
    words = {k: template_words(v) for k, v in sorted(templates.items())}
    if not all(words.values()):
        raise ValueError("templates: one without words")
    shingles = {k: template_shingles(w, n) for k, w in words.items()}
    spans = {k: min(n, len(w)) for k, w in words.items()}
    known = spark.createDataFrame(
        [(k, spans[k], shingles[k]) for k in shingles], "license string, span int, shingles array<string>"
    )
    cut = [(k, spans[k], [x.split() for x in s]) for k in shingles for s in segments(shingles[k])]
    parts = spark.createDataFrame(cut, "license string, span int, runs array<array<string>>")
    texts = docs.select(F.col(id_col).alias("doc_id"), F.col(text_col).alias("text"))

    found = None
    for span in sorted(set(spans.values())):
        lengths = {len(runs) for _, s, runs in cut if s == span}
        single, wide = 1 in lengths, max(lengths) > 1
        hashes = F.transform("runs", lambda r: F.xxhash64(*(F.xxhash64(F.get(r, F.lit(k))) for k in range(span))))
        own = F.when(F.size("runs") == 1, _signature(hashes, 1)).otherwise(_signature(hashes, bands))
        marks = parts.filter(F.col("span") == span).select("license", F.explode(own).alias("value")).distinct()
        # explode asks for its array twice unless that is a column: hence the arrays of one
        hashed = texts.select("doc_id", F.explode(F.array(shingle_hashes(text_words(F.col("text")), span))).alias("all"))
        starts = F.sequence(F.lit(0), F.size("all") - 1, F.lit(PART))
        pieces = hashed.filter(F.size("all") > 0).select(
            "doc_id", F.explode(F.transform(starts, _part(F.col("all"), PART + BLOCK))).alias("hashes")
        )
        sketched = pieces.select("doc_id", F.explode(F.array(window_values(F.col("hashes"), bands, single, wide))).alias("values"))
        values = sketched.select("doc_id", F.explode("values").alias("value"))
        hits = values.join(checked_broadcast(marks), "value").select("doc_id", "license")
        found = hits if found is None else found.unionByName(hits)
    pairs = materialise(found.distinct())
    # the few retrieved pairs go to where the texts are
    chosen = texts.withColumnRenamed("doc_id", "id").join(
        checked_broadcast(pairs), F.col("id").eqNullSafe(F.col("doc_id"))
    ).join(checked_broadcast(known), "license")
    contained = _let(
        text_words(F.col("text")),
        lambda w: F.size(F.array_intersect(F.col("shingles"), _runs(w, F.col("span")))),
    )
    return (
        chosen.select("doc_id", "license", contained.alias("matched"), F.size("shingles").alias("shingles"))
        .withColumn("containment", F.col("matched") / F.col("shingles"))
        .filter(F.col("containment") >= least)
    )


def _part(values: Column, length: int):
    return lambda p: F.slice(values, p + 1, length)


def _runs(words: Column, span: Column) -> Column:
    """All runs of ``span`` words as text."""
    starts = F.sequence(F.lit(1), F.greatest(F.lit(1), F.size(words) - span + 1))
    return F.transform(starts, lambda p: F.array_join(F.slice(words, p, span), " "))
