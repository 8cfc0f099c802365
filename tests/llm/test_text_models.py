import hashlib
import math
import re
import unicodedata
import zlib
from collections import Counter

import numpy as np
import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from tierflow.llm import chat, lm, quality, toxicity
from tierflow.llm.base import table

LOWER = str.maketrans({chr(c): chr(c + 32) for c in range(65, 91)})


def split(text):
    return re.findall(r"[^\x20\x09-\x0D]+", text or "")


def statistics(text):
    w = split(text)
    c, cover = Counter(zip(w, w[1:], w[2:], strict=False)), set()
    for i in range(len(w) - 2):
        if c[tuple(w[i : i + 3])] > 1:
            cover |= {i, i + 1, i + 2}
    lines = [x for x in (text or "").split("\n") if split(x)]
    return len(w), sum(map(len, w)), len(re.findall(r"[#*$%&|<>]", text or "")), len(lines) - len(set(lines)), len(cover)


def test_quality_statistics(documents, empty, by_id):
    got = quality.quality(documents).collect()
    assert len(got) == len(by_id) + 1
    for r in got:
        s = statistics(by_id[r.doc_id])
        assert (r.n_words, r.word_chars, r.n_symbols, r.n_dup_lines, r.n_repeat_words) == s
        assert r.base_failed == (s[0] < 50 or 100 * s[4] > 50 * s[0])
        assert not (r.base_failed and r.kept)
    assert quality.quality(empty).count() == 0


def test_quality_keeps_clean_and_rejects_junk(spark, sf):
    docs = table(spark, "/root/testdata/sf0.01", "documents")
    got = quality.quality(docs).join(table(spark, "/root/testdata/sf0.01", "labels"), "doc_id").where("not base_failed")
    n = {(r.quality, r.kept): r["count"] for r in got.groupBy("quality", "kept").count().collect()}
    assert n.get((1, False), 0) <= 0.01 * n[1, True]
    assert n.get((0, True), 0) <= 0.1 * n[0, False]


def test_quality_plan_has_no_python(documents):
    plan = quality.quality(documents)._jdf.queryExecution().toString()
    assert "Python" not in plan and "Pandas" not in plan and "Arrow" not in plan


def brute_em(rows, turns=30):
    """Dawid-Skene over the rows' votes, row by row, with the operator's start, smoothing and order of good and bad."""
    prior, n = 0.8, len(quality.RULES)
    good, bad = ([[*x] for _ in range(n)] for x in ([0.03, 0.2, 0.77], [0.35, 0.2, 0.45]))

    def odds(v):
        return math.prod(good[k][x + 1] / bad[k][x + 1] for k, x in enumerate(v)) * prior / (1 - prior)

    for _ in range(turns):
        p = [odds(v) / (1 + odds(v)) for v in rows]
        old = (prior, good, bad)
        prior = min(max((sum(p) + 1) / (len(p) + 2), 0.01), 0.99)
        good, bad = ([[(sum(w for v, w in zip(rows, ws, strict=True) if v[k] == x) + 1) / (sum(ws) + 3) for x in (-1, 0, 1)] for k in range(n)] for ws in (p, [1 - x for x in p]))
        for k in range(n):
            bad[k][0], good[k][2] = max(bad[k][0], good[k][0]), max(good[k][2], bad[k][2])
        if max(abs(a - b) for x, y in ((good, old[1]), (bad, old[2])) for u, w in zip(x, y, strict=True) for a, b in zip(u, w, strict=True)) < 1e-6 and abs(prior - old[0]) < 1e-6:
            break
    return [odds(v) / (1 + odds(v)) for v in rows]


def test_quality_verdict_against_em_in_plain_python(spark):
    docs = table(spark, "/root/testdata/sf0.01", "documents")
    judged = quality.judge(docs.select("doc_id", "text")).collect()
    want = brute_em([[r[f"_q_vote_{k}"] for k in quality.RULES] for r in judged])
    for r, p in zip(judged, want, strict=True):
        assert r._q_posterior == pytest.approx(p, abs=1e-6)
        assert r._q_kept == (not r._q_base_failed and p >= 0.5)


def plain_votes(text):
    """The vote of each rule on a text."""
    text = text or ""
    w, lines, n = split(text), [x for x in text.split("\n") if split(x)], statistics(text)
    chars, symbols, capitals = sum(map(len, w)), n[2], sum(unicodedata.category(c) == "Lu" for c in text)
    marked = len(re.findall(r"[#*$%&|<>][\x20\x09-\x0D]+", text))
    rules = {
        "symbols": (symbols, len(w), lambda x: x > 0.1, lambda x: x < 0.02),
        "density": (symbols, chars, lambda x: x > 0.02, lambda x: x < 0.005),
        "marked": (marked, len(w), lambda x: x > 0.1, lambda x: x < 0.02),
        "repeats": (n[4], len(w), lambda x: x > 0.4, lambda x: x < 0.3),
        "lines": (n[3], len(lines), lambda x: x > 0.5, lambda x: x < 0.4),
        "capitals": (capitals, chars, lambda x: x > 0.4, lambda x: x < 0.25),
        "shouting": (text.count("!"), len(w), lambda x: x > 0.2, lambda x: x < 0.05),
        "vocabulary": (len(set(w)), len(w), lambda x: x < 0.1, lambda x: x > 0.15),
        "length": (chars, len(w), lambda x: not 2.5 <= x <= 12, lambda x: 3 <= x <= 10),
    }
    return {k: 0 if not whole else -1 if against(part / whole) else 1 if good(part / whole) else 0 for k, (part, whole, against, good) in rules.items()}


def test_quality_votes_in_plain_python(documents, by_id):
    for r in quality.judge(documents.select("doc_id", "text")).collect():
        assert {k: r[f"_q_vote_{k}"] for k in quality.RULES} == plain_votes(by_id[r.doc_id])


def test_quality_drops_columns_of_its_own_names(spark):
    df = spark.createDataFrame([(1, "a b c", 7, "x")], "doc_id long, text string, _q_n_words int, other string")
    got = quality.judge(df)
    assert got.first()._q_n_words == 3 and "other" in got.columns and len(set(got.columns)) == len(got.columns)


def test_long_texts_repeat_windows_as_short_ones_do(spark):
    rng = np.random.default_rng(5)
    rows = [(k, " ".join(f"w{x}" for x in rng.integers(0, n, size))) for k, (n, size) in enumerate([(30, 6000), (300, 9000), (10**6, 20000), (12, quality.PACKED), (12, quality.PACKED + 1)])]
    got = {r.doc_id: r.n_repeat_words for r in quality.quality(spark.createDataFrame(rows, "doc_id long, text string")).collect()}
    assert got == {k: statistics(t)[4] for k, t in rows}


def test_quality_reads_the_patterns_in_one_job(spark, documents):
    spark.sparkContext.setJobGroup("em", "em")
    quality.judge(documents.select("doc_id", "text"))
    jobs = spark.sparkContext.statusTracker().getJobIdsForGroup("em")
    spark.sparkContext._jsc.clearJobGroup()
    assert len(jobs) <= 5  # the written table, the patterns and their sort


CONV = "conv_id long, turn long, role string, text string, formatted string"


def test_chat_digests(spark):
    said = {1: [("user", "hi <|end|> \\ [INST]"), ("assistant", "a</s>b\n"), ("assistant", "")], 2: [("system", ""), ("user", "x"), ("assistant", "<\\[")], 3: [("user", "only")], -7: [("user", chat.PROBE), ("assistant", chat.PROBE)]}
    rows = [(c, k, r, t or None, "f") for c, turns in said.items() if c != -7 for k, (r, t) in enumerate(turns)]
    got = {r.conv_id: r for r in chat.chat_digests(spark.createDataFrame(rows[::-1], CONV)).collect()}
    assert set(got) == set(said)
    for c, turns in said.items():
        loss = "".join(t for r, t in turns if r == "assistant")
        assert got[c].n_turns == len(turns)
        assert got[c].turns_sha256 == hashlib.sha256("".join(f"{r}\n{t}\n" for r, t in turns).encode()).hexdigest()
        assert (got[c].loss_chars, got[c].loss_sha256) == (len(loss), hashlib.sha256(loss.encode()).hexdigest())
        assert got[c].formatted_chars == sum(len(r) + len(t) + len(re.findall(r"[<\[\\]", r + t)) + 22 for r, t in turns)


def test_chat_edges(spark):
    assert [r.conv_id for r in chat.chat_digests(spark.createDataFrame([], CONV)).collect()] == [-7]
    rows = [(None, None, None, None, None), (5, 1, "user", "b", ""), (5, 1, "user", "a", ""), (5, 1, "user", "a", ""), (5, None, "assistant", "first", "")]
    got = {r.conv_id: r for r in chat.chat_digests(spark.createDataFrame(rows, CONV)).collect()}
    assert got[None].n_turns == 1
    assert got[5].turns_sha256 == hashlib.sha256(b"assistant\nfirst\nuser\na\nuser\na\nuser\nb\n").hexdigest()


def test_parts_become_placeholders(spark):
    rows = [(1, 0, "user", [("text", "look: <", None, None), ("image", None, "i.png", 2), ("audio", None, "a.wav", 10), ("video", None, "v", None)]), (1, 1, "assistant", None)]
    r = chat.format_chat(spark.createDataFrame(rows, f"conv_id long, turn long, role string, parts {chat.PARTS}")).first()
    assert r.formatted == "<|turn|>user<|sep|>look: <\\<|image|><|audio|><|document|><|end|><|turn|>assistant<|sep|><|end|>"
    assert [(a.type, a.ref, a.tokens) for a in r.attachments] == [("image", "i.png", 512), ("audio", "a.wav", 250), ("document", "v", 512)]
    assert r.expanded_tokens == 1274 and r.loss_spans[0].length == 0


def test_lm_base_score(documents, empty, by_id):
    rows = [*by_id.items(), (0, by_id[0])]
    tokens = {i: [*(w.translate(LOWER) for w in split(t)), 0] for i, t in by_id.items()}
    c = Counter(w for i, _ in rows if zlib.crc32(str(i).encode()) % 10 for w in tokens[i])
    n, v = sum(c.values()), len(c)
    got = lm.score(documents, head=64, thin=1, rounds=1).collect()
    assert len(got) == len(rows)
    for r in got:
        x = tokens[r.doc_id]
        base = sum(math.log10((c[w] + 0.1) / (n + 0.1 * (v + 1))) for w in x)
        assert (r.held_out, r.n_tokens, r.n_known, r.train_tokens) == (zlib.crc32(str(r.doc_id).encode()) % 10 == 0, len(x), sum(c[w] > 0 for w in x), n)
        assert r.base_score == pytest.approx(base, rel=1e-9) and -1e9 < r.score < 0
    assert lm.score(empty).count() == 0


def test_lm_score_against_one_token_at_a_time(spark, monkeypatch):
    """The model's score recomputed word by word in plain Python, with the weights that were learned."""
    from tierflow.llm.textscan import span_hash

    rng, held = np.random.default_rng(11), {}
    rows = [(i, " ".join(f"w{int(k)}{'x' * int(k % 23)}" for k in np.minimum(rng.zipf(1.3, rng.integers(0, 60)), 5000))) for i in range(300)]
    fit = lm.fit
    monkeypatch.setattr(lm, "fit", lambda *a: held.setdefault("fitted", fit(*a)))
    got = {r.doc_id: r.score for r in lm.score(spark.createDataFrame(rows, "doc_id long, text string"), head=700).collect()}
    vocab, weights, counts = held["fitted"]
    p = {k: v.astype(float) for k, v in lm.unflat(weights).items()}
    count = {r.h: (r.c, r.lc) for r in counts.collect()}
    rank = {int(k): int(v) for k, v in zip(vocab.keys, vocab.place, strict=True)}
    kind = {h: int(vocab.cls[r]) for h, r in rank.items()}
    sums = Counter()
    for h, (c, lc) in count.items():
        sums[kind[h] if h in kind else ("rest", lc)] += c
    distinct = Counter(lc for h, (_, lc) in count.items() if h not in rank)

    def probability(h, size, state):
        logit = state @ p["wc"] + p["bc"]
        lc = 0 if size is None else int(np.searchsorted(lm.LENGTHS, size))
        cls = kind.get(h, lm.GROUPS + lm.BINS + lc)
        out = math.exp(logit[cls] - logit.max()) / np.exp(logit - logit.max()).sum()
        c = count.get(h, (0, 0))[0]
        if h in rank and rank[h] < lm.LEARNED:
            inner = state @ p["wv"][cls] + p["bv"][cls]
            return out * math.exp(inner[rank[h] % lm.GROUP] - inner.max()) / np.exp(inner - inner.max()).sum(), rank[h]
        if h in rank:
            return out * c / sums[cls], lm.LEARNED + cls
        return out * (c + 0.1) / (sums["rest", lc] + 0.1 * (distinct[lc] + 1)), lm.LEARNED + cls

    for i, text in rows[::7]:
        state, fed, total = np.zeros(lm.H), lm.START, 0.0
        words = [(int(span_hash(b, np.array([0]), np.array([len(b)])).view(np.int64)[0]), len(b)) for b in (np.frombuffer(w.encode(), np.uint8) for w in split(text))]
        for h, size in [*words, (int(lm.END), None)]:
            a, g = p["wx"][fed], state @ p["u"]
            z, r = (1 / (1 + np.exp(-(a[k : k + lm.H] + g[k : k + lm.H]))) for k in (0, lm.H))
            new = np.tanh(a[2 * lm.H :] + r * g[2 * lm.H :])
            state = (1 - z) * new + z * state
            q, fed = probability(h, size, state)
            total += math.log10(q)
        assert got[i] == pytest.approx(total, rel=1e-4, abs=1e-3)


def test_lm_trains_on_every_training_document(spark, documents, monkeypatch):
    kept = {}
    keep = lm.Workspace.keep

    def noted(self, df, name, *rest):
        kept[name] = keep(self, df, name, *rest)
        return kept[name]

    monkeypatch.setattr(lm.Workspace, "keep", noted)
    want = lm.score(documents, head=64).first().train_tokens
    for k in range(2):
        assert kept[f"replicas{k}"].agg(F.sum("seen")).first()[0] == want


def vocabulary(n):
    rng = np.random.default_rng(4)
    h = rng.integers(1, 2**62, n)
    return lm.Vocabulary(h, np.sort(rng.integers(1, 500, n))[::-1].astype(np.int64), {k: (50, 20) for k in range(len(lm.LENGTHS) + 1)}, 10**5, 900)


def test_lm_probabilities_sum_to_one():
    vocab = vocabulary(700)
    p = lm.initial(vocab)
    rank = np.arange(700)
    cls = np.empty(700, np.int64)
    cls[vocab.place] = vocab.cls[vocab.place]
    state = np.random.default_rng(1).standard_normal((1, lm.H)).astype(np.float32)
    own = np.exp(lm.log_probs(p, np.repeat(state, 700, 0), cls, rank)) * 10**vocab.inside
    others = np.exp(lm.log_probs(p, np.repeat(state, len(lm.LENGTHS) + 1, 0), lm.GROUPS + lm.BINS + np.arange(len(lm.LENGTHS) + 1), np.full(8, -1)))
    empty_bins = [k for k in range(lm.GROUPS + lm.BINS) if k not in set(cls.tolist())]
    rest = np.exp(lm.log_probs(p, np.repeat(state, len(empty_bins), 0), np.array(empty_bins), np.zeros(len(empty_bins), int))).sum() if empty_bins else 0
    assert own.sum() + others.sum() + rest == pytest.approx(1, abs=1e-3)


def test_lm_state_is_carried():
    vocab = vocabulary(600)
    p, rng = lm.initial(vocab), np.random.default_rng(2)
    rank = rng.integers(0, 512, 300)
    cls, ids = (rank // lm.GROUP).astype(np.int64), rank.astype(np.int16)
    lens = np.array([100, 3, 197])
    want = lm.score_rows(p, rank, cls, ids, lens)
    assert lm.score_rows(p, rank, cls, ids, lens, window=7) == pytest.approx(want)
    assert lm.score_rows(p, rank[100:103], cls[100:103], ids[100:103], lens[1:2]) == pytest.approx(want[1:2])


def test_lm_learns():
    vocab = vocabulary(600)
    rank = np.tile(np.array([3, 77, 140, 500, 9]), 2000)
    cls, ids, lens = (rank // lm.GROUP).astype(np.int64), rank.astype(np.int16), np.full(100, 100)
    before = lm.score_rows(lm.initial(vocab), rank, cls, ids, lens).sum()
    p = lm.train_replica(lm.initial(vocab), rank, cls, ids, lens, streams=16)
    assert lm.score_rows(p, rank, cls, ids, lens).sum() > 0.5 * before


def test_lm_gradient():
    """One training step moves against the numerical gradient."""
    vocab = vocabulary(600)
    rng = np.random.default_rng(7)
    rank = rng.integers(0, 512, 64)
    cls, ids, lens = (rank // lm.GROUP).astype(np.int64), rank.astype(np.int16), np.array([64])
    p = lm.initial(vocab)
    after = lm.train_replica({k: v.copy() for k, v in p.items()}, rank, cls, ids, lens, streams=1, span=64, rate=1e-3)
    for k in ("u", "wc", "bv"):
        at = np.unravel_index(np.argmax(np.abs(after[k] - p[k])), p[k].shape)
        q = {n: v.astype(np.float64) for n, v in p.items()}
        values = []
        for e in (1e-4, -1e-4):
            q[k][at] = p[k][at] + e
            values.append(lm.score_rows(q, rank, cls, ids, lens)[0])
        assert (values[0] - values[1]) * (after[k] - p[k])[at] > 0


def test_lm_exponentials():
    """Small logits need no shift, large ones and rows that vanish under the others' shift do."""
    logit = np.random.default_rng(5).standard_normal((9, 4)).astype(np.float32)
    for add in (0.0, -50.0, 80.0, np.where(np.arange(9) < 4, 0, 300)[:, None], np.where(np.arange(9) < 4, 0, -300)[:, None]):
        x = logit + np.float32(add)
        e, total, shift = lm.exps(x)
        want = np.exp(x - x.max(axis=1, keepdims=True).astype(np.float64))
        assert np.allclose(e / total[:, None], want / want.sum(axis=1, keepdims=True), rtol=1e-4)
        assert np.allclose(np.log(total) + shift, np.log(want.sum(axis=1)) + x.max(axis=1), rtol=1e-5)
    assert not lm.exps(np.abs(logit))[2].any()


def test_lm_training_against_plain_steps():
    """Training recomputed in plain Python, stream by stream and token by token, with the sums of the same windows."""
    vocab, rng = vocabulary(600), np.random.default_rng(3)
    n, streams, span, rate, H = 149, 3, 8, 0.01, lm.H
    rank = np.where(rng.random(n) < 0.2, -1, np.minimum(rng.zipf(1.2, n), 560) - 1)
    cls = np.where(rank < 0, lm.GROUPS + lm.BINS + rng.integers(0, 8, n), np.where(rank < lm.LEARNED, rank // lm.GROUP, lm.GROUPS + 3))
    ids = np.where((rank >= 0) & (rank < lm.LEARNED), rank, lm.LEARNED + cls).astype(np.int16)
    lens = np.array([1, 20, 49, 2, 70, 7])
    got = lm.train_replica(lm.initial(vocab), rank, cls, ids, lens, streams=streams, span=span, rate=rate)
    p, starts, width = {k: v.astype(float) for k, v in lm.initial(vocab).items()}, set((np.cumsum(lens) - lens).tolist()), -(-n // streams)
    m, v, state = {k: 0 * x for k, x in p.items()}, {k: 0 * x for k, x in p.items()}, [np.zeros(H)] * streams
    for turn, lo in enumerate(range(0, width, span), 1):
        g, cells = {k: 0 * x for k, x in p.items()}, [[s * width + k for k in range(lo, min(lo + span, width)) if s * width + k < n] for s in range(streams)]
        weight = 1 / sum(map(len, cells))
        for s, places in enumerate(cells):
            steps = []
            for at in places:
                fed, before = (lm.START, np.zeros(H)) if at in starts else (ids[at - 1], state[s])
                a, r = p["wx"][fed], before @ p["u"]
                z, q = (1 / (1 + np.exp(-(a[k : k + H] + r[k : k + H]))) for k in (0, H))
                c = np.tanh(a[2 * H :] + q * r[2 * H :])
                state[s] = (1 - z) * c + z * before
                steps.append((at, fed, before, z, q, c, r[2 * H :], state[s]))
            dh = np.zeros(H)
            for at, fed, before, z, q, c, r, h in reversed(steps):
                for out, w, b, k in [(cls[at], "wc", "bc", ...)] + [(rank[at] % lm.GROUP, "wv", "bv", cls[at])] * int(cls[at] < lm.GROUPS):
                    e = np.exp(h @ p[w][k] + p[b][k])
                    e *= weight / e.sum()
                    e[out] -= weight
                    g[w][k] += np.outer(h, e)
                    g[b][k] += e
                    dh = dh + p[w][k] @ e
                dc = dh * (1 - z) * (1 - c * c)
                dz, dq = dh * (before - c) * z * (1 - z), dc * r * q * (1 - q)
                g["wx"][fed] += np.concatenate((dz, dq, dc))
                back = np.concatenate((dz, dq, dc * q))
                g["u"] += np.outer(before, back)
                dh = (dh * z + p["u"] @ back) * (at not in starts)
        scale = min(1, 1 / np.sqrt(sum((x * x).sum() for x in g.values())))
        for k in p:
            m[k], v[k] = 0.9 * m[k] + 0.1 * scale * g[k], 0.999 * v[k] + 0.001 * (scale * g[k]) ** 2
            p[k] = p[k] - rate / (1 - 0.9**turn) * m[k] / (np.sqrt(v[k] / (1 - 0.999**turn)) + 1e-6)
    for k in p:
        assert np.allclose(got[k], p[k], atol=1e-4), k


def test_grammar_readings():
    def read(*symbols):
        sums = dict.fromkeys(toxicity.READINGS, 0.0)
        toxicity.read_clause(list(symbols), [1.0] * len(symbols), sums)
        return {k for k, v in sums.items() if v}

    t = toxicity
    assert read(t.INSULT) == {"plain"}
    assert read(t.TARGET, t.WORD, t.INSULT) == {"targeted"}
    assert read(t.NEGATION, t.WORD, t.INSULT) == {"negated"}
    assert read(t.NEGATION, t.WORD, t.WORD, t.WORD, t.INSULT) == {"plain"}
    assert read(t.SPEECH_VERB, t.TARGET, t.INSULT) == {"reported"}
    assert read(t.THREAT) == set() and read(t.TARGET, t.THREAT) == {"threat"}


def test_grammar_is_the_composition_of_its_parts():
    """Each string of up to five symbols, fed through the five transducers one after the other."""
    import itertools

    t = toxicity
    parts = [t.threats(), t.targets(), t.negations(), t.reports(), t.insults()]
    for n in range(1, 6):
        for string in itertools.product(t.SYMBOLS, repeat=n):
            states, state = [p.start for p in parts], t.GRAMMAR.start
            for symbol in string:
                state, got = t.GRAMMAR.arcs[state, symbol]
                for k, p in enumerate(parts):
                    states[k], symbol = p.step(states[k], symbol)
                assert got == symbol
    assert {r for _, r in t.GRAMMAR.arcs.values()} == {None, *t.READINGS}


def test_findings_against_reading_clause_by_clause():
    t, rng = toxicity, np.random.default_rng(9)
    lists = {t.INSULT: t.INSULTS, t.THREAT: t.THREATS, t.TARGET: t.TARGETS, t.NEGATION: t.NEGATIONS, t.SPEECH_VERB: t.SPEECH, t.WORD: ["mill", "river", "stone"]}
    kind = {w: k for k, words in lists.items() for w in words if w.isalpha()}
    words = sorted(kind)
    texts = [" ".join(words[k] + "." * int(rng.random() < 0.1) for k in rng.integers(0, len(words), rng.integers(0, 40))) for _ in range(300)]
    from tierflow.llm.base import text_buffers

    b, offs = text_buffers(pa.array(texts))
    got = t.findings(b, offs, t.Lexicon({}))
    for text, row in zip(texts, got, strict=True):
        sums, top = dict.fromkeys(t.READINGS, 0.0), 0.0
        for clause in text.split("."):
            string = [kind[w] for w in clause.split()]
            top = max(top, t.read_clause(string, [t.GENERAL] * len(string), sums))
        marks = text.count(".")
        assert row[: len(sums)].tolist() == [sums[k] for k in t.READINGS] and row[-2] == top and len(text.split()) <= row[-1] <= len(text.split()) + marks


@pytest.fixture(scope="module", params=["doc_id < 6000", "doc_id >= 4000", "doc_id % 2 = 0"])
def subset(spark, request):
    sf = "/root/testdata/sf0.1"
    docs, labels = table(spark, sf, "documents").where(request.param), table(spark, sf, "labels")
    return docs, labels


def test_toxicity_on_held_out_rows(subset):
    docs, labels = subset
    got = toxicity.toxicity(docs, labels)
    r = got.join(labels, "doc_id").where("held_out").agg(*(F.expr(f"count_if({c})").alias(n) for n, c in {"tp": "toxic = 1 and predicted = 1", "p": "toxic = 1", "fp": "toxic = 0 and predicted = 1", "n": "toxic = 0"}.items())).first()
    assert r.tp >= 0.85 * r.p and r.fp <= 0.01 * r.n


def test_the_grammar_decides(spark, subset):
    docs, labels = subset
    m = toxicity.train(docs, labels)
    assert m.factors["threat"] > 0 and m.factors["targeted"] > m.factors["plain"] > max(m.factors["negated"], m.factors["reported"])
    assert all(c >= 0 for c in m.coefficients[:-1]) and sum(m.coefficients[:-1]) > 0
    words = "one fine day the people of the town went out to look at the old mill by the river and came home late"
    said = {1: "idiot", 2: f"{words} idiot", 3: "you idiot", 4: "you are a stupid worthless idiot", 5: "I will kill you", 6: "he said you idiot", 7: "you are not an idiot", 8: words}
    texts = list(said.values())
    from tierflow.llm.base import text_buffers

    b, offs = text_buffers(pa.array(texts))
    found = toxicity.findings(b, offs, toxicity.Lexicon({}))
    score = dict(zip(said, m.scores(found), strict=True))
    assert max(score[k] for k in (1, 2, 6, 7, 8)) < 0.5 < min(score[k] for k in (3, 4, 5))


def test_copies_are_no_evidence(spark):
    """Hundreds of copies of one toxic text do not make its ordinary words toxic."""
    rng = np.random.default_rng(12)
    common = [f"common{k}" for k in range(200)]
    plain = lambda n: " ".join(rng.choice(common, n))
    copied = " ".join(f"ordinary{k} walk" for k in range(60))
    rows = [(k, plain(60)) for k in range(150)] + [(1000 + k, f"{plain(20)} grobbling grobbling {plain(20)} grobbling") for k in range(60)]
    rows += [(2000 + k, f"{copied} grobbling grobbling grobbling extra{k}") for k in range(300)]
    labels = [(i, int(i >= 1000)) for i, _ in rows]
    new = [(9001, copied), (9002, plain(60)), (9003, f"{plain(30)} grobbling and grobbling grobbling")]
    docs = spark.createDataFrame(rows + new, "doc_id long, text string")
    got = {r.doc_id: r.predicted for r in toxicity.toxicity(docs, spark.createDataFrame(labels, "doc_id long, toxic int")).collect()}
    assert [got[k] for k, _ in new] == [0, 0, 1]


def test_conflicting_labels_count_as_toxic(spark):
    rows = [(k, f"plain words number {k} again") for k in range(40)] + [(100 + k, f"you zorkface and zorkface number {k}") for k in range(40)]
    labels = [(k, 0) for k, _ in rows if k < 100] + [(k, y) for k, _ in rows if k >= 100 for y in (0, 1, None)]
    docs, labels = spark.createDataFrame(rows, "doc_id long, text string"), spark.createDataFrame(labels, "doc_id long, toxic int")
    got = {r.doc_id: r.predicted for r in toxicity.toxicity(docs, labels).collect()}
    assert all(got[k] == (k >= 100) for k in got)


def test_toxicity_edges(spark, documents, empty, by_id):
    none = spark.createDataFrame([], "doc_id long, toxic int, quality int")
    got = {r.doc_id: r for r in toxicity.toxicity(documents, none).collect()}
    assert len(got) == len(by_id) and all(0 <= r.score <= 1 and r.predicted == int(r.score >= 0.5) for r in got.values())
    blank = next(i for i, t in by_id.items() if t is None)
    assert got[blank].score < 0.5 and got[blank].held_out == (zlib.crc32(str(blank).encode()) % 5 == 0)
    assert toxicity.toxicity(empty, none).count() == 0
    bad = spark.createDataFrame([(1, "You are a stupid worthless idiot."), (2, "A fine day."), (None, None)], "doc_id long, text string")
    left = toxicity.without_toxic(bad, none)
    assert left.columns == ["doc_id", "text"] and {r.doc_id for r in left.collect()} == {2, None}
