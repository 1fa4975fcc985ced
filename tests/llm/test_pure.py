"""Parts that need no Spark: searches and codecs against brute force."""

import random
import re
import time

import numpy as np
import pyarrow as pa
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st

from rewardmill.llm import chat, jaccard, langid, licenses, packing, pii, toxicity
from rewardmill.llm.maxscore import Shard
from rewardmill.llm.queries import tokenizer_path

VOCABULARY = tokenizer_path("word_bpe_49k.json")


def test_ids_are_the_tokenizers():
    from tokenizers import Tokenizer

    whole = Tokenizer.from_file(VOCABULARY)
    texts = ["", " ", "Plain words, and 12 numbers.", "a<|endoftext|>b", "Σίσυφος ΣΑΣ İx", "don't we'll_x __ x²3", "é ́a", "\x1fa\tb\r\nc\x85d", "ﬁ Ⅷ 漢字 👍🏽", "ÀÉÎ straße!?", "x" * 5000]
    for text, ids in zip(texts, packing.encode_texts(texts, VOCABULARY)):
        assert np.frombuffer(ids, "<u4").tolist() == whole.encode(text, add_special_tokens=False).ids, text


def items(plan):
    out = {}
    for pattern, n in plan.items():
        assert sum(pattern) <= 100
        for x in pattern:
            out[x] = out.get(x, 0) + n
    return out


@settings(max_examples=40, deadline=None)
@given(st.dictionaries(st.integers(1, 100), st.integers(1, 40), min_size=1, max_size=12), st.integers(0, 99))
def test_every_packing_holds_every_item_once(hist, seed):
    rng = random.Random(seed)
    pool = packing.seed_population(hist, 100, 4, seed)
    pool.append(packing.crossover(pool[0], pool[1], hist, 100, rng))
    pool.append(packing.mutate(pool[2], hist, 100, rng))
    evolved = packing.evolve(pool, hist, 100, 10, seed)
    for plan in [*pool, *evolved]:
        assert items(plan) == hist
        assert sum(plan.values()) >= packing.lower_bound(hist, 100)
    assert packing.fitness(evolved[0], 100) <= min(packing.fitness(p, 100) for p in pool)


def test_evolution_beats_best_fit_decreasing():
    hist = {45: 2, 38: 1, 17: 1, 34: 1, 21: 1, 55: 1, 16: 1, 29: 1, 33: 1, 41: 1, 26: 1}  # fills four bins
    assert sum(packing.best_fit(hist, 100).values()) == 5
    plan = packing.evolve(packing.seed_population(hist, 100, 8, 3), hist, 100, 200, 3)[0]
    assert sum(plan.values()) == packing.lower_bound(hist, 100) == 4


@settings(max_examples=30, deadline=None)
@given(st.integers(0, 10_000))
def test_divide_skip_equals_counting(seed):
    rng = np.random.default_rng(seed)
    pick = lambda n: np.unique(rng.integers(0, 60, n).astype(np.uint64))
    query = pick(40)
    members = [np.unique(np.r_[rng.choice(query, len(query) * rng.integers(5, 11) // 10), pick(rng.integers(1, 8))]) for _ in range(12)] + [pick(5)]
    expected = [k for k, m in enumerate(members) if 100 * len(np.intersect1d(query, m)) >= 75 * len(np.union1d(query, m))]
    assert jaccard.divide_skip(query, members, 75) == expected
    as_info = lambda t: (len(t), 8 * len(jaccard.parity_bits(t)), int.from_bytes(jaccard.parity_bits(t), "little"))
    hashed = lambda t: jaccard._mix(t)
    for k in expected:
        assert jaccard.may_link(as_info(hashed(query)), as_info(hashed(members[k])), 75)


def test_shingles():
    count = lambda t: len(jaccard.shingle_set(t))
    assert [count(t) for t in (None, "", " \n\t", "one", "a b c d", "a b c d e", "a b c d e f", "a b c d e a b c d e")] == [0, 0, 0, 1, 1, 1, 2, 5]
    same = lambda a, b: np.array_equal(jaccard.shingle_set(a), jaccard.shingle_set(b))
    assert same("A b  C\vd\fE", "a B c d e") and not same("É b c d e", "é b c d e") and not same("a b", "b a") and not same("a b c d", "a b c d e")
    assert same("x\x85y a b c d", "x\x85y a b c d") and count("x\x85y a b c d e") == 2


@settings(max_examples=25, deadline=None)
@given(st.integers(0, 10_000), st.integers(1, 25))
def test_maxscore_equals_all_products(seed, k):
    rng = np.random.default_rng(seed)
    terms = rng.integers(-4, 5, (60, 9)) * (rng.random((60, 9)) < 0.7)
    ids = rng.permutation(60) // 2 * 3  # repeated ids
    query, own = rng.integers(-4, 5, 9), int(ids[0])
    got = Shard(ids, terms).top(own, query, k)
    scores = sorted(((-int(t @ query), int(i)) for i, t in zip(ids, terms) if i != own))[:k]
    assert list(zip((-got[1]).tolist(), got[0].tolist())) == scores


def brute_spans(text):
    out = []
    for m in pii._EMAIL.finditer(text):
        out.append(("email", *m.span()))
    out += [("ip", *m.span()) for m in pii._IP.finditer(text) if all(int(p) <= 255 for p in m.group().split("."))]
    digits = lambda s: "".join(c for c in s if c in "0123456789")
    out += [("card", *m.span()) for m in pii._CARD.finditer(text) if 13 <= len(digits(m.group())) <= 19 and pii.luhn(digits(m.group()))]
    out += [("phone", *m.span()) for m in pii._PHONE.finditer(text) if 9 <= len(digits(m.group())) <= 15]
    return out


@settings(max_examples=300, deadline=None)
@given(st.text("a@.-1 4+()\n%0é", max_size=60))
def test_base_spans_are_the_patterns(text):
    assert pii.base_spans(text) == brute_spans(text)


def test_pii_contexts_and_redaction():
    text = 'Mail x.y@mail.example.com or token = "9f8e7d6c5b" now'
    base, more = pii.find_spans(text, {"token =": 1.0})
    assert [k for k, _, _ in base] == ["email"] and [text[s:e] for _, s, e in more] == ["9f8e7d6c5b"]
    assert pii.redacted(text, [*base, *more]) == 'Mail [EMAIL] or token = "[CONTEXT]" now'
    assert pii.find_spans(None, {}) == ([], []) and pii.redacted("plain", []) == "plain"


ROLES = st.sampled_from(["user", "assistant", "system", "tool", "", "<s>"]) | st.none()
BITS = st.lists(st.sampled_from([*chat.CONTROLS, "\x1a", "a", "é", " ", "\n", "[", "<", "/INST]", "漢"]), max_size=8).map("".join) | st.none()


@settings(max_examples=150, deadline=None)
@given(st.lists(st.tuples(ROLES, BITS), max_size=6))
def test_chat_round_trip(turns):
    roles, texts = pa.array([r for r, _ in turns], pa.string()), pa.array([t for _, t in turns], pa.string())
    buffer, at, lo, hi = chat.assemble(roles, texts)
    text = buffer.tobytes().decode()
    assert chat.parse(text) == [(r or "", t or "") for r, t in turns]
    assert at[-1] == len(buffer) and len(at) == len(turns) + 1
    loss = [chat.unescape(buffer[a:b].tobytes().decode()) for a, b in zip(lo, hi) if a >= 0]
    assert loss == [t or "" for r, t in turns if r == "assistant"]


def test_rank_order_distance():
    grams, counts = langid.ngram_counts("Ab ab 12 b")
    assert len(grams) and counts.max() >= 3 and len(langid.ngram_counts("12 ... ")[0]) == 0
    top = langid.ranked(grams, counts, 5)
    order = np.argsort(top)
    ranks = np.empty((5, 2), np.int64)
    ranks[:, 0] = np.arange(5)[order]
    ranks[:, 1] = 5
    assert langid.distances("Ab ab 12 b", top[order], ranks, 5).tolist() == [0.0, 1.0]
    assert langid.distances("123", top[order], ranks, 5) is None


def letters(*kinds):
    return [(k, {"i": 2.0, "v": 2.0}.get(k, 0.0), 0.0) for k in kinds]


def test_grammar_composes():
    weigh = lambda *s: toxicity.clause_score(letters(*s))[0]
    assert weigh("o", "i") == 2.0 and weigh("t", "o", "i") == 2.6 == weigh("i", "o", "t") and weigh("n", "i") == pytest.approx(0.6)
    assert weigh("r", "o", "i") == pytest.approx(0.8) and weigh("o", "o") == 0.0 and weigh("n", "t", "i") == pytest.approx(0.78)
    assert weigh("p", "l", "i") == 2.4 == weigh("p", "l", "i") and weigh("i", "i") == 4.4
    assert weigh("w", "v", "t") == 2.0 == weigh("t", "w", "v") and weigh("v", "t") == 1.0 and weigh("w", "v") == 0.0
    assert toxicity.clause_score(letters("n", "i")) == (pytest.approx(0.6), 2.0)


@pytest.mark.parametrize("name, clause", [("insult", "oi"), ("threat", "wvt"), ("negation", "ni"), ("report", "roi"), ("target", "ti"), ("target", "it"), ("target", "wv")])
def test_every_machine_counts(name, clause):
    rest = toxicity.compose(*(m for k, m in toxicity.MACHINES.items() if k != name))
    assert toxicity.clause_score(letters(*clause), rest) != toxicity.clause_score(letters(*clause))


def test_scorer_is_linear_in_the_text():
    s = toxicity.Scorer(toxicity.Lexicon({"moron": 5.0}))
    for text in ("moron " * 150_000, "moron. " * 120_000, "x" * 500_000 + " moron" * 50_000):
        began = time.perf_counter()
        assert s.features(text)[1] >= 5.0
        assert time.perf_counter() - began < 8


def test_scorer_reads_clauses():
    s = toxicity.Scorer(toxicity.Lexicon({"moron": 5.0}, {"scumm": 4.0}))
    f = lambda t: s.features(t)[1]
    assert f("He is a moron.") > f("He is not a moron.") > 0 == f("fine; oxymoron") == f("") == f(None)
    assert f("scummiest of all") == 4.0 and f("I will kill you") > 0 == f("kill the process")


def test_segments_fit_their_windows():
    for m in range(1, 300):
        parts = licenses.segments([str(k) for k in range(m)])
        assert {int(x) for p in parts for x in p} == set(range(m))
        assert {len(p) for p in parts} <= ({1} if m < 4 else {4, 5})
        assert all(p == [str(int(p[0]) + k) for k in range(len(p))] for p in parts)


def slow_identifiers(text, taken):
    out = []
    for m in re.finditer(r"(?=[^\s]*[0-9@])[\w@.+-]{5,}", text):
        s, e = m.span()
        e -= len(text[s:e]) - len(text[s:e].rstrip(".-+"))
        token = text[s:e]
        digits = sum("0" <= c <= "9" for c in token)
        if e - s >= 5 and (digits and any(c.isalpha() for c in token) or digits >= 7 or "@" in token) and not any(s < b and a < e for a, b in taken):
            out.append((s, e))
    return out


PIECES = st.sampled_from(["ab", "1", "22", "@", ".", "-", " ", "\n", "=", '"', "(", "x9y8z", "key", ":", "\t", "é", "A", "."])


@settings(max_examples=300, deadline=None)
@given(st.lists(PIECES, max_size=14).map("".join))
def test_identifiers_and_their_contexts(text):
    taken = [(s, e) for _, s, e in pii.base_spans(text)]
    assert pii.identifiers(text, taken) == slow_identifiers(text, taken)
    found = {p for line in text.lower().split("\n") for both in pii.contexts(line) for p in both}
    for s, _ in pii.identifiers(text, taken):
        before = re.sub("[0-9]", "0", text[text.rfind("\n", 0, s) + 1 : s].lower().rstrip(pii._OPENING)).split()[-2:]
        before = [w[-pii.TOKEN_TAIL :] for w in before]
        assert pii.patterns_before(text, s) == ([before[1], " ".join(before)] if len(before) == 2 else before)
        assert found.issuperset(pii.patterns_before(text, s))


@pytest.mark.parametrize("text", ["1" * 1_000_000, "a" * 1_000_000 + "1", "k=a1b2c3&" * 110_000, "1.1.1 " * 160_000, "a@" * 500_000, "tok ab12c34 " * 90_000])
def test_personal_data_is_linear_in_the_text(text):
    began = time.perf_counter()
    pii.find_spans(text, {"x": 1.0})
    pii.contexts(text)
    assert time.perf_counter() - began < 4


@settings(max_examples=25, deadline=None)
@given(st.integers(0, 10_000))
def test_maxscore_with_a_floor_keeps_what_reaches_it(seed):
    rng = np.random.default_rng(seed)
    terms, ids = rng.integers(-9, 10, (3_000, 6)) * 7, np.arange(3_000)
    query = rng.integers(-9, 10, 6)
    scores = terms @ query
    order = np.lexsort((ids, -scores))
    order = order[order != 5][:10]
    for floor in (None, int(scores[order[-1]]), int(scores[order[3]])):
        got = Shard(ids, terms).top(5, query, 10, floor)
        sure = [i for i in order if floor is None or scores[i] >= floor]
        assert got[0].tolist()[: len(sure)] == sure




WORDS = st.sampled_from(["moron", "scummy", "you", "not", "said", "will", "kill", "piece", "of", "the", "park", "oxymoron", "don't", "."])


@settings(max_examples=300, deadline=None)
@given(st.lists(st.tuples(WORDS, st.sampled_from([" ", " ", ". ", "; ", "\n", ", "])), max_size=14))
def test_features_are_the_clauses_sums(words):
    text = "".join(w + gap for w, gap in words)
    scorer = toxicity.Scorer(toxicity.Lexicon({"moron": 5.0}, {"scumm": 4.0}))
    total = best = weak = 0.0
    found = set()
    for clause in re.split(r"[.!?;:\n|]", text):
        own = [scorer.letter(w) for w in toxicity._WORD.findall(clause)]
        if any(k in "iv" for k, _, _ in own):
            found |= {w for w, x in zip(toxicity._WORD.findall(clause), own) if x[0] == "i"}
            score, weakened = toxicity.clause_score(own)
            total, weak, best = total + score, weak + weakened, max(best, score)
    want = (np.log1p(total), best, np.log1p(len(found)), np.log1p(weak))
    assert scorer.features(text) == pytest.approx(want)


def slow_profile(texts, size):
    counts = {}
    for t in texts:
        for w in re.findall(r"[^\W\d_]+", t.lower()):
            padded = f" {w} "
            for n in (1, 2, 3):
                for k in range(len(padded) - n + 1):
                    gram = padded[k : k + n]
                    if gram.strip() and (n < 3 or gram[0] + gram[2] != "  "):
                        counts[gram] = counts.get(gram, 0) + 1
    code = lambda g: sum(ord(c) << 21 * (len(g) - 1 - k) for k, c in enumerate(g))
    return [code(g) for g in sorted(counts, key=lambda g: (-counts[g], code(g)))][:size]


@settings(max_examples=60, deadline=None)
@given(st.lists(st.text("abcé äZ.1", max_size=25), min_size=2, max_size=4))
def test_distances_are_out_of_place_sums(texts):
    size = 12
    profiles = [slow_profile([t], size) for t in texts[1:]]
    grams = np.array(sorted({g for p in profiles for g in p}), dtype=np.int64)
    ranks = np.array([[p.index(g) if g in p else size for p in profiles] for g in grams.tolist()], dtype=np.int64).reshape(-1, len(profiles))
    own = slow_profile(texts[:1], size)
    if not own or not len(grams):
        return
    got = langid.distances(texts[0], grams, ranks, size)
    want = [sum(abs(p.index(g) - k) if g in p else size for k, g in enumerate(own)) / (size * len(own)) for p in profiles]
    assert got.tolist() == pytest.approx(want)


def test_ngrams_do_not_depend_on_spans(monkeypatch):
    text = "The quick brown fox, über 12 Häuser; jumps " * 7
    whole = [x.tolist() for x in langid.ngram_counts(text)]
    for span in (1, 2, 3, 50):
        monkeypatch.setattr(langid, "SPAN", span)
        assert [x.tolist() for x in langid.ngram_counts(text)] == whole
