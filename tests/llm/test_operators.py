"""Operators on small tables: nulls, empty and long texts, ties, repeated rows, extra columns."""

import hashlib
import json
import re
import zlib

import numpy as np
import pytest
from pyspark.sql import functions as F

from rewardmill.llm import chat, jaccard, langid, licenses, maxscore, mixing, nndescent, packing, pii, queries, toxicity
from rewardmill.llm.common import connected_components, doc_bucket

VOCABULARY = queries.tokenizer_path("word_bpe_49k.json")
DOC = "doc_id long, text string, lang string, source string, n_chars long"
BASE = "the quick brown fox jumps over the lazy dog while seven wise owls watch from an old oak tree near the river bank at dawn today"
EN = "this is the house that the others have built with their own hands and it was there before the war"
DE = "das ist das haus welches die anderen mit ihren eigenen händen gebaut haben und es war schon vor dem krieg da"


def documents(spark, rows, extra=()):
    df = spark.createDataFrame([(i, t, lang, src, None if t is None else len(t)) for i, t, lang, src in rows], DOC)
    for name in extra:
        df = df.withColumn(name, F.lit("clash"))
    return df


@pytest.fixture(scope="module")
def docs(spark):
    words = BASE.split()
    rows = [
        (0, BASE, "en", "src0"), (1, BASE.upper(), "en", "src0"), (2, " ".join([*words[:-1], "tomorrow"]), "en", "src1"),
        (3, " ".join(words[:12]), "en", "src1"), (4, None, "en", "src1"), (5, "", "de", "src2"), (6, "   \n", None, None),
        (7, "four words only here", "de", "src2"), (8, "FOUR words  only\there", "de", "src2"), (9, "%%% 123", "en", "src3"),
        (10, DE, "de", "src3"), (11, EN, "en", "src3"), (12, DE + " und " + EN, "de", "src0"), (13, "word " * 9000, "en", "src0"),
        (11, EN, "en", "src3"), (None, EN, "en", "src4"), (14, "call +1 (555) 010-9999 or a.b@c.example or 4111 1111 1111 1111 at 10.0.0.1", "en", "src1"),
    ]
    return documents(spark, rows, extra=("k1", "length", "id", "score", "component", "pivot", "_n", "tokens")).persist()


def empty(docs):
    return docs.filter("doc_id = -1")


def test_components(spark):
    edges = [(k, k + 1) for k in range(40)] + [(100, k) for k in range(101, 140)] + [(7, 7), (200, 201), (201, 200)]
    got = {r["node"]: r["component"] for r in connected_components(spark.createDataFrame(edges, "u long, v long")).collect()}
    assert got == {k: 0 for k in range(41)} | {k: 100 for k in range(100, 140)} | {200: 200, 201: 200}


def brute_components(rows):
    word = re.compile(r"[^\x20\x09-\x0D]+")
    sets = {}
    for i, t in rows:
        w = [x.encode().lower().decode() for x in word.findall(t or "")]
        sets.setdefault(i, []).append({tuple(w[k : k + 5]) for k in range(max(1, len(w) - 4))} if w else set())
    flat = [(i, s) for i, all_ in sets.items() for s in all_]
    root = list(range(len(flat)))
    find = lambda x: x if root[x] == x else find(root[x])
    for a, (_, s) in enumerate(flat):
        for b in range(a):
            t = flat[b][1]
            if s and t and 100 * len(s & t) >= 75 * len(s | t):
                root[find(a)] = find(b)
    comp = {}
    for k, (i, _) in enumerate(flat):
        comp.setdefault(find(k), []).append(i)
    return sorted((i, len(s), min(comp[find(k)])) for k, (i, s) in enumerate(flat))


def test_jaccard_components_equal_brute_force(spark, docs):
    rng = np.random.default_rng(5)
    words = [f"w{k}" for k in range(400)]
    rows = [(r["doc_id"], r["text"]) for r in docs.filter("doc_id IS NOT NULL").collect()]
    base = list(rng.choice(words, 60))
    for k in range(60):  # near copies round one text, and pairs near the bound
        w = list(base)
        for at in rng.integers(0, 60, rng.integers(1, 4)):
            w[at] = f"x{rng.integers(0, 9)}"
        rows.append((100 + k, " ".join(w)))
    rows += [(200 + k, " ".join(rng.choice(words, rng.integers(5, 30)))) for k in range(30)]
    df = spark.createDataFrame(rows, "doc_id long, text string").withColumn("k1", F.lit("clash"))
    got = sorted(map(tuple, jaccard.components(df).collect()))
    assert got == brute_components(rows)
    kept = sorted(r["doc_id"] for r in jaccard.keep_one(df).collect())
    assert kept == sorted({i for i, _, c in got if i == c})
    assert jaccard.components(empty(docs)).count() == 0


def test_canopy_size_decides_no_result(spark, monkeypatch):
    rng = np.random.default_rng(9)
    words = [f"w{k}" for k in range(200)]
    rows = []
    for g in range(12):  # groups of near copies round the bound, of 2 to 13 texts
        base = list(rng.choice(words, 40))
        for k in range(g + 2):
            w = list(base)
            for at in rng.integers(0, 40, rng.integers(0, 3)):
                w[at] = f"y{rng.integers(0, 5)}"
            rows.append((100 * g + k, " ".join(w)))
    df = spark.createDataFrame(rows, "doc_id long, text string")
    want = brute_components(rows)
    for bound in (2, 6, 100):
        monkeypatch.setattr(jaccard, "SMALL_CANOPY", bound)
        assert sorted(map(tuple, jaccard.components(df).collect())) == want


def test_shared_digests_merge_no_classes(spark):
    words = [f"w{k}" for k in range(400)]
    rng = np.random.default_rng(3)
    rows = [(k, " ".join(rng.choice(words, 20))) for k in range(60)]
    rows += [(100 + k, rows[k][1]) for k in range(20)] + [(None, rows[5][1]), (None, "alone in the world with no id"), (7, rows[8][1])]
    df = spark.createDataFrame(rows, "doc_id long, text string")
    want = sorted(map(str, jaccard.components(df).collect()))
    assert sorted(map(str, jaccard.components(df, key_bits=3).collect())) == want
    got = [(r["doc_id"], r["component_id"]) for r in jaccard.components(df).collect()]
    assert got.count((None, 5)) == 1 and got.count((None, None)) == 1 and (7, 7) in got and (8, 7) in got
    kept = [(r["doc_id"], r["text"]) for r in jaccard.keep_one(df.withColumn("_row", F.lit("mine"))).collect()]
    assert sorted(kept, key=str) == sorted([(k, t) for k, t in rows[:60] if k != 8] + [(7, rows[8][1]), (None, "alone in the world with no id")], key=str)


def test_columns_of_any_name_keep_their_values(docs):
    odd = ("score", "distance", "lang_pred", "_guess", "mix_lang", "mix_tokens", "_epochs", "_limit", "_key", "_row", "row", "predicted", "kind")
    df = docs.drop("score").withColumns({c: F.concat(F.lit(c), F.col("n_chars").cast("string")) for c in odd})
    mine = {(r["doc_id"], r["text"]): tuple(r[c] for c in odd) for r in df.collect()}
    levels = {"lang": F.col("lang"), "source": F.col("source")}
    for out in (
        langid.keep_identified(df, F.col("doc_id").isin(10, 11)), mixing.choose(df, levels, {}, 0.9), jaccard.keep_one(df),
    ):
        assert out.columns == df.columns
        rows = out.collect()
        assert rows and all(tuple(r[c] for c in odd) == mine[(r["doc_id"], r["text"])] for r in rows)
    clean = pii.redact(df)
    assert clean.columns == df.columns and {tuple(r[c] for c in odd) for r in clean.collect()} == set(mine.values())


def test_long_texts_are_read_whole(spark):
    long = " ".join(f"{w}{k % 997}" for k, w in enumerate(EN.split() * 20_000))[:1_000_000] + " Released under the MIT License. " + "x" * 300_000
    rows = [(1, long, "en", "src0"), (2, long, "en", "src0"), (3, EN, "en", "src0"), (4, DE, "de", "src0")]
    df = documents(spark, rows)
    assert {r["license"] for r in licenses.scan(df.filter("doc_id = 1")).collect()} == {"MIT"}
    assert [r["component_id"] for r in jaccard.components(df).orderBy("doc_id").collect()] == [1, 1, 3, 4]
    assert langid.identify(df, F.col("doc_id") > 2).filter("doc_id = 1").first()["lang_pred"] == "en"
    assert pii.extract(df, {}).count() == 4
    turns = spark.createDataFrame([(1, 0, "user", long), (1, 1, "assistant", long), (1, 2, "assistant", "</s>")], "conv_id long, turn long, role string, text string")
    got = chat.digests(chat.format_chats(turns)).first()
    assert (got["n_turns"], got["loss_chars"]) == (3, len(long) + 4)
    assert got["loss_sha256"] == hashlib.sha256((long + "</s>").encode()).hexdigest()


def test_packing(spark, docs):
    from tokenizers import Tokenizer

    whole = Tokenizer.from_file(VOCABULARY)
    rows = packing.pack(docs, VOCABULARY, capacity=128, islands=2, generations=5, epochs=2).collect()
    texts = sorted((str(r["doc_id"]), r["text"] or "") for r in docs.collect())
    expected = []
    for i, t in texts:
        ids = whole.encode(t, add_special_tokens=False).ids + [1]
        for k in range(0, len(ids), 128):
            cut = np.array(ids[k : k + 128], "<u4")
            expected.append((i, k // 128, k, len(cut), zlib.crc32(cut.tobytes())))
    assert sorted((str(r["doc_id"]), r["piece"], r["start"], r["length"], r["ids_crc32"]) for r in rows) == sorted(expected)
    at = {}
    for r in sorted(rows, key=lambda r: (r["sequence_id"], r["offset"])):
        assert r["offset"] == at.get(r["sequence_id"], 0)
        at[r["sequence_id"]] = r["offset"] + r["length"]
    assert max(at.values()) <= 128 and len(at) <= -(-sum(at.values()) // 128) + 1
    assert packing.pack(empty(docs), VOCABULARY).count() == 0


def test_language(docs):
    seen = langid.identify(docs, F.col("doc_id").isin(10, 11)).collect()
    by = {r["doc_id"]: r for r in seen}
    assert len(seen) == docs.count() and by[10]["lang_pred"] == "de" and by[11]["lang_pred"] == "en"
    assert {i for i, r in by.items() if r["lang_pred"] == "und"} == {4, 5, 6, 9}
    assert all(0 <= r["score"] <= 1 for r in seen)
    kept = langid.keep_identified(docs, F.col("doc_id").isin(10, 11))
    assert kept.columns == docs.columns and {4, 5, 6, 9}.isdisjoint(r["doc_id"] for r in kept.collect())
    assert langid.identify(empty(docs), F.lit(True)).count() == 0
    assert {r["lang_pred"] for r in langid.identify(docs, F.lit(False)).collect()} == {"und"}


def test_held_out_language_accuracy(spark):
    rows = queries.QUERIES["op3_rank_order_language"](spark, "/root/testdata/sf0.001").join(
        spark.read.parquet("/root/testdata/sf0.001/documents.parquet").select("doc_id", "lang"), "doc_id"
    ).filter("held_out").collect()
    assert sum(r["lang"] == r["lang_pred"] for r in rows) >= 0.95 * len(rows)


def test_pii(docs):
    got = {r["doc_id"]: r for r in pii.extract(docs, {}).collect()}
    row = got[14]
    assert (row["n_email"], row["n_ip"], row["n_card"], row["n_phone"]) == (1, 1, 1, 1)
    assert row["base_sha256"] == hashlib.sha256(row["spans"].encode()).hexdigest()
    assert got[4]["spans"] == "" and len(got) == docs.select("doc_id").distinct().count()
    clean = pii.redact(docs).filter("doc_id = 14").first()["text"]
    assert clean == "call [PHONE] or [EMAIL] or [CARD] at [IP]"
    assert pii.learn_patterns(empty(docs)) == {} and pii.redact(empty(docs)).count() == 0


def test_bootstrap_finds_contexts(spark):
    rows = [(k, f"user ref: a.b{k}@c.example wrote" if k % 2 else f"user ref: QX{k}77Z{k} wrote and the {k}{k}{k}1234567 too") for k in range(40)]
    rows += [(100 + k, "the dog and the cat and the bird") for k in range(40)]
    df = spark.createDataFrame(rows, "doc_id long, text string")
    patterns = pii.learn_patterns(df, least_score=0.3)
    assert "ref:" in patterns and "the" not in patterns
    assert all(r["n_context"] == 1 for r in pii.extract(df.filter("doc_id < 100 AND doc_id % 2 = 0"), patterns).collect())


def slow_patterns(texts, rounds=3, least_instances=5, least_score=0.55, prior=4.0):
    """The pattern-instance graph in plain Python."""
    words = "token password secret key ssn passport iban".split()
    edges, seeds, totals = {}, set(), {}
    for text in texts:
        spans = [(s, e) for _, s, e in pii.base_spans(text)]
        for seed, (s, e) in [*((1, x) for x in spans), *((0, x) for x in pii.identifiers(text, spans))]:
            for p in pii.patterns_before(text, s):
                n, was = edges.get((p, text[s:e].lower()), (0, 0))
                edges[p, text[s:e].lower()] = (n + 1, max(was, seed))
        for line in text.lower().split("\n"):
            for p in (p for both in pii.contexts(line) for p in both if p):
                totals[p] = totals.get(p, 0) + 1
    named = lambda p: any(re.search(rf"(^|[\s\"'_-])({w})s?\W*( ?[=:]+)?$", p) for w in words)
    start = {}
    for (p, i), (_, seed) in edges.items():
        start[i] = max(start.get(i, 0.0), 1.0 if seed or named(p) else 0.0)
    of = {}
    for (p, i), (n, _) in edges.items():
        of.setdefault(p, {})[i] = n
    worth, score = dict(start), {}
    for _ in range(rounds):
        score = {p: sum(worth[i] * n for i, n in x.items()) / (max(totals.get(p, 0), sum(x.values())) + prior) for p, x in of.items() if len(x) >= least_instances}
        worth = {i: max(start[i], max((score.get(p, 0.0) for p, x in of.items() if i in x), default=0.0)) for i in start}
    unseen = {p for (p, _), (_, seed) in edges.items() if not seed}
    return {p: v for p, v in score.items() if v >= least_score and p in unseen}


def test_patterns_equal_a_graph_in_plain_python(spark):
    rng = np.random.default_rng(11)
    rows = []
    for k in range(150):
        ident = f"q{rng.integers(0, 60)}x{k % 7}z9"
        form = rng.choice(["password={}", "mail a.b{}@c.example or", 'the ref: "{}"', "ref: {} and", "badge {}", "see {} here", "user mail x{}@y.example", "the {}", "Token  : ({})"])
        rows.append((k, f"{rng.choice(['we', 'they', 'the ref:'])} " + form.format(ident) + "\n" + rng.choice(["the cat", "see the dog", "badge"])))
    df = spark.createDataFrame(rows, "doc_id long, text string")
    got, want = pii.learn_patterns(df, least_score=0.2), slow_patterns([t for _, t in rows], least_score=0.2)
    assert want and got.keys() == want.keys() and all(abs(got[p] - want[p]) < 1e-9 for p in want)


def test_held_out_toxicity(spark):
    home = "/root/testdata/sf0.1"
    rows = queries.QUERIES["op10_toxic_grammar"](spark, home).join(spark.read.parquet(f"{home}/labels.parquet").select("doc_id", "toxic"), "doc_id").filter("held_out").collect()
    bad, good = [r["score"] for r in rows if r["toxic"]], [r["score"] for r in rows if not r["toxic"]]
    auc = sum((b > g) + 0.5 * (b == g) for b in bad for g in good) / (len(bad) * len(good))
    assert auc >= 0.94 and sum(r["predicted"] for r in rows if not r["toxic"]) <= 0.01 * len(good)


def test_contexts_that_touch_their_identifier(spark):
    forms = ["api_key={}", "password:{}", '{{"secret":"{}"}}', "ssn:{}", "iban={}"]
    rows = [(100 * f + k, "we set " + form.format(f"sk{k}f8a{f}b6c{k}d") + " then") for f, form in enumerate(forms) for k in range(12)]
    df = spark.createDataFrame(rows, "doc_id long, text string")
    patterns = pii.learn_patterns(df)
    assert {"api_key=", "password:", '{"secret":', "ssn:", "iban="} <= set(patterns)
    assert all(r["n_context"] == 1 for r in pii.extract(df, patterns).collect())
    assert all("[CONTEXT]" in r["text"] for r in pii.redact(df).collect())
    text = 'Set "secret":"ab12cd34" or key = (ab12cd34 or x:y=ab12cd34'
    found = {p for one_two in pii.contexts(text.lower()) for p in one_two}
    assert all(p in found for s, _ in pii.identifiers(text, []) for p in pii.patterns_before(text, s))


def test_no_candidate_or_accepted_pattern_is_cut(spark):
    names = [f"{a}{b}{c}{d}" for a in "bcdfghjk" for b in "aeiou" for c in "lmnprstvwz" for d in "bcdfghjkl"][:2_100]
    rows = [(i, "\n".join(f"token {w}: ab{k}cd{i}ef" for k in range(5))) for i, w in enumerate(names)]
    rows += [(10_000 + i, "\n".join(f"{w}: ab{k}cd{i}ef" for k in range(5))) for i, w in enumerate(names)]
    df = spark.createDataFrame(rows, "doc_id long, text string")
    patterns = pii.learn_patterns(df, least_score=0.0)
    assert len(names) == 2_100 and {f"{w}:" for w in names} | {f"token {w}:" for w in names} <= set(patterns)
    edges = pii._occurrences(df, "text").groupBy("pattern").count().filter("count >= 5").select("pattern")
    totals = {r["pattern"]: r["total"] for r in pii._totals(df, edges, edges.count(), "text").collect()}
    assert totals[f"{names[-1]}:"] == 10 and totals[f"token {names[0]}:"] == 5


def test_chat(spark):
    rows = [(1, 1, "assistant", "yes </s>"), (1, 0, "user", None), (2, 0, None, "x"), (2, 1, "tool", "\x1a[INST]"), (None, 0, "user", "lost"), (1, 1, "assistant", "yes </s>")]
    df = spark.createDataFrame(rows, "conv_id long, turn long, role string, text string").withColumn("chunk", F.lit("clash"))
    chunks = chat.format_chats(df).collect()
    assert chat.parse("".join(c["formatted"].decode() for c in chunks if c["conv_id"] == 2)) == [("", "x"), ("tool", "\x1a[INST]")]
    got = {r["conv_id"]: r for r in chat.digests(chat.format_chats(df)).collect()}
    text = "user\n\nassistant\nyes </s>\nassistant\nyes </s>\n"
    assert got[1]["turns_sha256"] == hashlib.sha256(text.encode()).hexdigest() and got[1]["loss_chars"] == 16
    assert got[None]["n_turns"] == 1 and chat.digests(chat.format_chats(df.filter("turn > 9"))).count() == 0


def test_toxicity(spark, docs):
    rows = [(k, ("You are a moron and a scumbag" if k % 4 == 0 else "We walk in the park") + f" w{k}.", int(k % 4 == 0)) for k in range(120)]
    df = spark.createDataFrame(rows, "doc_id long, text string, toxic int")
    labels = df.select("doc_id", "toxic").union(spark.createDataFrame([(None, 1), (3, None)], "doc_id long, toxic int"))
    scored = toxicity.classify(df.drop("toxic"), labels, F.col("doc_id") < 90).join(df.select("doc_id", "toxic"), "doc_id").filter("doc_id >= 90").collect()
    assert all(r["predicted"] == r["toxic"] and 0 <= r["score"] <= 1 for r in scored)
    none = toxicity.classify(docs, labels, F.lit(False)).collect()
    assert len(none) == docs.count() and {r["predicted"] for r in none} == {0}


def vectors(spark, n=300, dim=8):
    rng = np.random.default_rng(2)
    rows = [(k, [float(np.float32(x)) for x in rng.standard_normal(dim) / 3]) for k in range(n)]
    rows += [(n + k, rows[0][1]) for k in range(30)]  # equal vectors
    odd = [(9000, None), (9001, [0.0] * (dim - 1) + [float("nan")]), (9002, [None] * dim), (9003, [float("inf")] * dim), (None, [0.5] * dim), (9020, [0.0] * dim)]
    return rows, spark.createDataFrame(rows + odd, "vec_id long, embedding array<float>").withColumn("rank", F.lit("clash"))


def test_maxscore_is_exact(spark):
    rows, df = vectors(spark)
    q = np.array([[int(np.floor(64 * x)) for x in v] for _, v in rows] + [[0] * 8])
    ids = [i for i, _ in rows] + [9020]
    expected = []
    for a, i in enumerate(ids):
        if i % 20 == 0:
            best = sorted((-int(q[a] @ q[b]), j) for b, j in enumerate(ids) if j != i)[:5]
            expected += [(i, r + 1, j, -s) for r, (s, j) in enumerate(best)]
    got = maxscore.top_k(df, F.col("vec_id") % 20 == 0, k=5).select("query_id", "rank", "vec_id", "score").collect()
    assert sorted(map(tuple, got)) == sorted(expected)
    assert maxscore.top_k(df.filter("vec_id < 0"), F.lit(True)).count() == 0


def test_maxscore_keeps_large_components(spark):
    rng = np.random.default_rng(4)
    rows = [(i, [float(x) for x in rng.standard_normal(4)]) for i in range(60)]
    rows += [(100 + i, [float(x) for x in rng.standard_normal(4) * 2.0 ** e]) for i, e in enumerate((19, 20, 21, 22, 24, 24))]
    rows += [(200, [2.0**45, 1.0, -1.0, 0.0]), (201, [-1.0, 2.0**20, 0.5, 3.0])]
    df = spark.createDataFrame(rows, "vec_id long, embedding array<double>")
    q = {i: [int(np.floor(64 * x)) for x in v] for i, v in rows}
    expected = []
    for i in (0, 20, 100, 105, 201):
        best = sorted((-sum(a * b for a, b in zip(q[i], q[j])), j) for j in q if j != i)[:5]
        expected += [(i, r + 1, j, -s) for r, (s, j) in enumerate(best) if -s < 2**63]
    ask = F.col("vec_id").isin(0, 20, 201)
    got = maxscore.top_k(df, ask, k=5).select("query_id", "rank", "vec_id", "score").collect()
    assert sorted(map(tuple, got)) == sorted(e for e in expected if e[0] in (0, 20, 201))
    less = df.filter("vec_id != 200")
    for i, r in {100: 5, 105: 5}.items():
        best = sorted((-sum(a * b for a, b in zip(q[i], q[j])), j) for j in q if j not in (i, 200))[:r]
        found = maxscore.top_k(less, F.col("vec_id") == i, k=r).orderBy("rank").collect()
        assert [(-x["score"], x["vec_id"]) for x in found] == best
    with pytest.raises(Exception, match="64 bits"):
        maxscore.top_k(df.union(df.filter("vec_id = 200").withColumn("vec_id", F.lit(300).cast("long"))), F.col("vec_id") == 200).collect()


def test_nn_descent_recall(spark):
    rows, df = vectors(spark)
    x = np.array([v for _, v in rows])
    got = {}
    for r in nndescent.nearest(df, F.col("vec_id") % 20 == 0, k=5, degree=10, iterations=2, beam=30).collect():
        got.setdefault(r["query_id"], []).append((r["rank"], r["vec_id"], r["score"]))
    hits = total = 0
    for a in range(0, len(rows), 20):
        s = x @ x[a]
        best = sorted((-s[b], b) for b in range(len(rows)) if b != a)[:5]
        found = sorted(got[a])
        assert [r for r, _, _ in found] == [1, 2, 3, 4, 5] and all(abs(s[j] - v) < 1e-12 for _, j, v in found)
        hits += len({b for _, b in best} & {j for _, j, _ in found})
        total += 5
    assert hits >= 0.9 * total
    assert 9020 not in got and nndescent.nearest(df.filter("vec_id < 0"), F.lit(True)).count() == 0


def test_nn_descent_keeps_only_what_its_result_reads(spark, monkeypatch):
    made, real = [], nndescent.materialise
    monkeypatch.setattr(nndescent, "materialise", lambda df: made.append(real(df)) or made[-1])
    _, df = vectors(spark)
    found = nndescent.nearest(df, F.col("vec_id") == 20, k=5, degree=6, iterations=1, beam=10, rounds=1)
    where = lambda frames: {f.rpartition("/")[0] for d in frames for f in d.inputFiles()}
    left = [f for f in where(made) if nndescent_files(spark, f)]
    assert set(left) == where([found]) and found.count() == 5  # rows and all graphs are gone


def nndescent_files(spark, folder):
    path = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(folder)
    return path.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).exists(path)


def test_nn_descent_recall_on_many_vectors(spark):
    """The whole operator, with its own settings, where the first graph is far from exact."""
    n, dim = 20_000, 48
    x = np.random.default_rng(6).standard_normal((n, dim)).astype(np.float32)
    x /= np.linalg.norm(x, axis=1, keepdims=True)
    df = spark.createDataFrame([(i, v.tolist()) for i, v in enumerate(x)], "vec_id long, embedding array<float>")
    found = {}
    for r in nndescent.nearest(df, F.col("vec_id") % 200 == 0, k=20).collect():
        found.setdefault(r["query_id"], set()).add(r["vec_id"])
    hits = 0
    for q in range(0, n, 200):
        s = x @ x[q]
        s[q] = -9
        hits += len(found[q] & set(np.argpartition(-s, 20)[:20].tolist()))
    assert hits >= 0.9 * 20 * (n // 200)


def test_vectors_meet_their_own_length(spark):
    rows = [(i, [float(i), 1.0]) for i in range(1, 30)] + [(100 + i, [float(i), 1.0, 2.0]) for i in range(10)] + [(5, [50.0, 1.0])]
    df = spark.createDataFrame(rows, "vec_id long, embedding array<float>")
    got = {}
    for r in nndescent.nearest(df, F.col("vec_id").isin(1, 100), k=3).collect():
        got.setdefault(r["query_id"], {})[r["rank"]] = r["vec_id"]
    assert got == {1: {1: 5, 2: 29, 3: 28}, 100: {1: 101, 2: 102, 3: 103}}


def test_nn_search_goes_on_until_no_beam_is_fresh(spark, monkeypatch):
    n = 30  # a chain whose best nodes are at its far end, many rounds from the query
    df = spark.createDataFrame([(i, [float(i + 1)]) for i in range(n)], "vec_id long, embedding array<float>").coalesce(1)  # rows are numbered as ids
    chain = [(0, i, np.float32(i + 1).tobytes(), np.array([j for j in (i - 1, i + 1) if 0 <= j < n]).tobytes()) for i in range(n)]
    state = spark.createDataFrame(chain, "block int, id long, vec binary, nbr binary")
    monkeypatch.setattr(nndescent, "build_graph", lambda *a: state)
    got = nndescent.nearest(df, F.col("vec_id") == 0, k=3, degree=2, beam=4).orderBy("rank").collect()
    assert [r["vec_id"] for r in got] == [29, 28, 27]
    assert nndescent.beam_for(2_000, 20) == 160 < nndescent.beam_for(180_000, 20) < nndescent.beam_for(10**6, 20)
    assert nndescent.tables_for(2_000) == 8 < nndescent.tables_for(180_000)


def test_license_scan(spark, docs):
    long = "filler " * 300
    rows = [(0, f"{long} Released under the MIT License. {long}"), (1, "released UNDER the mit\nlicense"), (2, "Released under the license"), (3, None), (4, ""),
            (5, licenses.NOTICES["GPL-3.0"].replace("work", "thing") + licenses.NOTICES["Apache-2.0"]), (1, "released UNDER the mit\nlicense")]
    df = spark.createDataFrame(rows, "doc_id long, text string").withColumn("words", F.lit("clash"))
    got = sorted((r["doc_id"], r["license"], r["matched"]) for r in licenses.scan(df, least=0.6).collect())
    assert got == [(0, "MIT", 1), (1, "MIT", 1), (1, "MIT", 1), (5, "Apache-2.0", 4), (5, "GPL-3.0", 6)]
    assert licenses.scan(empty(docs)).count() == 0
    with pytest.raises(ValueError):
        licenses.scan(df, {"none": "!!"})


def test_bands_retrieve_templates_of_every_length(spark):
    rng = np.random.default_rng(8)
    words = [f"w{k}" for k in range(3_000)]
    lengths = [1, 2, 3, 4, 5, 6, 7, 8, 9, 13, 14, 21, 22, 40, 160]
    templates = {f"t{m}-{k}": " ".join(rng.choice(words, m, replace=False)) + (f" only{m}x{k}" if m < 3 else "") for m in lengths for k in range(8)}
    rows, want = [], set()
    for i, (name, text) in enumerate(templates.items()):
        for c in range(4):
            filler = [" ".join(rng.choice(words, rng.integers(0, 700))) for _ in range(2)]
            rows.append((10 * i + c, f"{filler[0]} {text} {filler[1]}"))
            want.add((10 * i + c, name))
    df = spark.createDataFrame(rows, "doc_id long, text string")
    got = {(r["doc_id"], r["license"]) for r in licenses.scan(df, templates).collect()}
    assert want <= got


def test_any_number_of_templates(spark, monkeypatch):
    monkeypatch.setattr("rewardmill.llm.common.SMALL_ROWS", 50)  # the joins without broadcast
    templates = {f"t{k}": f"notice number{k} of all the many" for k in range(6_000)}
    df = spark.createDataFrame([(1, "x notice number5 of all the many y"), (2, "notice number5999 of all the many"), (3, "notice of all the many")], "doc_id long, text string")
    got = sorted((r["doc_id"], r["license"], r["containment"]) for r in licenses.scan(df, templates, least=0.9).collect())
    assert got == [(1, "t5", 1.0), (2, "t5999", 1.0)]


def budgets(spark, leaves, weights, budget, epochs=1):
    rows = spark.createDataFrame(leaves, "a string, b string, tokens long")
    return {(r["a"], r["b"]): r["budget"] for r in mixing.leaf_budgets(rows, ["a", "b"], weights, budget, epochs).collect()}


def test_shortages_go_to_siblings_first(spark):
    leaves = [("x", "p", 10), ("x", "q", 1000), ("y", "r", 1000), ("y", "s", 1000)]
    assert budgets(spark, leaves, {}, 400) == {("x", "p"): 10, ("x", "q"): 190, ("y", "r"): 100, ("y", "s"): 100}
    short = [("x", "p", 10), ("x", "q", 20), ("y", "r", 1000), ("y", "s", 1000)]
    assert budgets(spark, short, {}, 400) == {("x", "p"): 10, ("x", "q"): 20, ("y", "r"): 185, ("y", "s"): 185}
    assert budgets(spark, short, {"a": {"y": 0}}, 400) == {("x", "p"): 10, ("x", "q"): 20, ("y", "r"): 0, ("y", "s"): 0}
    assert budgets(spark, leaves, {}, 10_000, 2) == {(a, b): 2 * n for a, b, n in leaves}
    assert set(budgets(spark, leaves, {}, -5).values()) == {0}


def test_mix_takes_epochs_and_prefixes(spark, docs):
    levels = {"lang": F.col("lang"), "source": F.col("source")}
    rows = mixing.mix(docs, levels, {"lang": {"en": 3}}, budget_share=0.5, max_epochs=2).collect()
    per = {}
    for r in rows:
        per.setdefault((r["mix_lang"], r["mix_source"]), []).append(r["mix_tokens"])
    total = docs.select(F.sum(mixing.space_tokens(F.col("text")))).first()[0]
    assert sum(map(sum, per.values())) <= total * 0.5 and "text" in rows[0].asDict()
    everything = mixing.mix(docs, levels, {}, budget_share=1.0, max_epochs=1)
    want = [r["doc_id"] for r in docs.filter("length(text) > 0").collect()]
    assert sorted(map(str, (r["doc_id"] for r in everything.collect() if r["mix_tokens"]))) == sorted(map(str, want))
    assert mixing.mix(empty(docs), levels, {}).count() == 0


def test_pipeline(spark, tmp_path):
    import corpus_pipeline

    home = "/root/testdata/sf0.001"
    given = spark.read.parquet(f"{home}/documents.parquet").limit(60)
    rows = [tuple(r) for r in given.collect()] + [(900, None, "en", "src1", None), (901, "12 !!", "en", "src2", 5), (902, "Copy of mine: a.b@c.example " + EN, "en", "src1", 9), (903, "Copy of mine: a.b@c.example " + EN, "en", "src1", 9)]
    spark.createDataFrame(rows, DOC).write.parquet(str(tmp_path / "documents.parquet"))
    df, kept = spark.read.parquet(str(tmp_path / "documents.parquet")), {}
    for name, stage in corpus_pipeline.STAGES:
        df = stage(spark, df, str(tmp_path)).persist()
        kept[name] = [r.asDict() for r in df.collect()]
        if name != "packing":
            assert df.columns == given.columns
    ids = {n: {r["doc_id"] for r in v} for n, v in kept.items()}
    assert {900, 901}.isdisjoint(ids["language_id"]) and {902, 903} <= ids["language_id"]
    expected = {i for i, _, c in brute_components([(r["doc_id"], r["text"]) for r in kept["language_id"]]) if i == c}
    assert ids["near_duplicates"] == expected == ids["personal_data"]
    assert "[EMAIL]" in next(r["text"] for r in kept["personal_data"] if r["doc_id"] == 902)
    assert ids["mixing"] < ids["personal_data"] and ids["packing"] == ids["mixing"]
    assert len(corpus_pipeline.STAGES) == 5 and json.dumps(sorted(ids))
    assert doc_bucket("doc_id", 4) is not None
