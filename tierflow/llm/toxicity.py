"""Toxicity by a weighted finite-state pattern grammar whose lexical weights are learned from labels.

Lexical layer: whole units and byte prefixes of units carry log-odds learned from labelled rows, beside a short general
list of insults, threats, targets, negations and verbs of speech. It turns a clause into a string of symbols.

Grammar layer: five transducers read that string, one after the other: threat (a threat verb with a target on either side),
target (an insult after a target), negation (what stands within its reach), reported speech (what follows its verb) and
insult (events to readings). ``compose`` makes one machine of them; its events carry the lexical weight of their unit. A
document's strength is the sum over its events, each times the factor of its reading; the strongest event that aims at
nobody and threatens nobody is left out, so one isolated word never decides.

Calibration: a logistic layer over the strength and its share of the text. Lexicon weights are learned on all folds but
one and the logistic layer and the factors are fitted on the events found in the fold left out, so that they see weights
as they are on unseen text. Near copies count once and lie in one fold. Factors keep the order of the grammar: threat and targeted above plain, plain above negated
and reported.

Learning reads at most ``sample`` toxic and twice as many clean labelled rows of the training folds, those with the smallest
hashes of their ids; all scoring covers every row and the whole text. Labels, language, source and id are no inputs of a score.

Defined cases: null, empty and clean texts get the score of a text without findings; without labelled rows the general
list alone scores; null ids count as the empty text in the folds; equal texts get equal scores; a document with several
labels is toxic if one of them says so; extra columns are ignored; an empty table gives no rows.
"""

from __future__ import annotations

from itertools import product

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F

from tierflow.llm.base import Workspace, crc_mod, ragged, row_chunks, rows_of, text_buffers
from tierflow.llm.textscan import U, lowered, mix, shingles, span_hash, word_spans
from tierflow.llm.word_bpe import units

# The general word lists, in several languages.
INSULTS = "idiot idiots moron morons stupid scum loser losers trash pathetic worthless disgusting clown bastard jerk fool imbecile dumb filthy vermin".split()
THREATS = "kill hurt destroy beat shoot stab murder crush burn punish töten umbringen schlagen tuer frapper matar golpear".split()
TARGETS = "you your yours u he she they them him her du dich dir ihr euch sie tu te toi vous il elle ils tú ti usted ustedes ellos ella".split()
NEGATIONS = "not never no nobody isn't aren't don't doesn't nicht kein keine nie ne pas jamais non nunca jamás".split()
SPEECH = "said says say wrote writes claimed called quoted reported according sagte sagt schrieb laut dit écrit selon dijo dice según".split()

PREFIXES = (3, 4, 5, 6, 7, 8)
SYMBOLS = INSULT, THREAT, TARGET, NEGATION, SPEECH_VERB, WORD = ("insult", "threat", "target", "negation", "speech", "word")
READINGS = ("plain", "targeted", "threat", "negated", "reported")
REACH = 3  # words that a target or a negation reaches
FOLDS = 5
GENERAL = 3.0  # weight of the general list's insults and threats
#: Factors of the readings before any label is seen, and those among which the fit chooses.
FACTORS = {"plain": 1.0, "targeted": 1.5, "threat": 2.0, "negated": 0.25, "reported": 0.25}
CHOICES = {"targeted": (1.2, 1.5, 2.0, 3.0), "negated": (0.1, 0.25, 0.5), "reported": (0.1, 0.25, 0.5)}
DEFAULT = [0.7, 3.4, -6.0]


def _word_hash(word: str) -> int:
    b = np.frombuffer(word.encode(), np.uint8)
    return int(span_hash(b, np.array([0]), np.array([len(b)]))[0])


LISTS = {kind: {_word_hash(w) for w in words} for kind, words in ((THREAT, THREATS), (TARGET, TARGETS), (NEGATION, NEGATIONS), (SPEECH_VERB, SPEECH))}


class Transducer:
    """A deterministic transducer: arcs from (state, symbol read) to (next state, symbol written). Other symbols pass."""

    def __init__(self, start, arcs: dict):
        self.start, self.arcs = start, arcs

    def step(self, state, symbol):
        return self.arcs.get((state, symbol), (state, symbol))

    def compose(self, other: Transducer, alphabet) -> Transducer:
        """The transducer that feeds what this one writes to ``other``; only states that can be reached are made."""
        start = (self.start, other.start)
        arcs, todo, known = {}, [start], {start}
        while todo:
            state = todo.pop()
            for symbol in alphabet:
                mine, written = self.step(state[0], symbol)
                theirs, out = other.step(state[1], written)
                arcs[state, symbol] = ((mine, theirs), out)
                if (mine, theirs) not in known:
                    known.add((mine, theirs))
                    todo.append((mine, theirs))
        return Transducer(start, arcs)


def threats() -> Transducer:
    """A threat verb up to REACH words after a target, or a target up to REACH words after a threat verb: a threat at someone.

    States: how near the last target and the last threat verb are.
    """
    arcs = {}
    for near, verb in product(range(REACH + 1), repeat=2):
        after = max(near - 1, 0), max(verb - 1, 0)
        arcs |= {((near, verb), x): (after, x) for x in (NEGATION, SPEECH_VERB, WORD)}
        arcs[(near, verb), INSULT] = ((near, after[1]), INSULT)
        arcs[(near, verb), THREAT] = ((near, 0), "threat at") if near else ((0, REACH), WORD)
        arcs[(near, verb), TARGET] = ((REACH, 0), "threat at" if verb else TARGET)
    return Transducer((0, 0), arcs)


def targets() -> Transducer:
    """An insult up to REACH words after a target, other insults not counted, is aimed at it. State: how near the target is."""
    arcs = {}
    for near in range(REACH + 1):
        arcs |= {(near, x): (max(near - 1, 0), x) for x in (NEGATION, SPEECH_VERB, WORD)}
        arcs |= {(near, x): (REACH, x) for x in (TARGET, "threat at")}
        arcs[near, INSULT] = (near, "insult at" if near else INSULT)
    return Transducer(0, arcs)


EVENTS = (INSULT, "insult at", "threat at")


def negations() -> Transducer:
    """Events up to REACH words after a negation are negated. State: the words it still reaches."""
    arcs = {}
    for left in range(REACH + 1):
        arcs |= {(left, x): (max(left - 1, 0), x) for x in (TARGET, SPEECH_VERB, WORD)}
        arcs |= {(left, x): (left, "negated" if left else x) for x in EVENTS}
        arcs[left, NEGATION] = (REACH, NEGATION)
    return Transducer(0, arcs)


def reports() -> Transducer:
    """Events after a verb of speech are reported, to the clause's end."""
    told = {(True, x): (True, "reported") for x in (*EVENTS, "negated")}
    return Transducer(False, told | {(False, SPEECH_VERB): (True, SPEECH_VERB)})


def insults() -> Transducer:
    """Names the reading of each event; all other symbols are silent."""
    named = {INSULT: "plain", "insult at": "targeted", "threat at": "threat", "negated": "negated", "reported": "reported"}
    return Transducer(0, {(0, x): (0, named.get(x)) for x in (*SYMBOLS, *named)})


def compose() -> Transducer:
    machine = threats()
    for part in (targets(), negations(), reports(), insults()):
        machine = machine.compose(part, SYMBOLS)
    return machine


GRAMMAR = compose()


def read_clause(symbols: list[str], weights: list[float], sums: dict[str, float]) -> float:
    """Adds the clause's events to ``sums``; returns the largest weight among those that are neither aimed nor a threat."""
    state, top = GRAMMAR.start, 0.0
    for symbol, weight in zip(symbols, weights, strict=True):
        state, reading = GRAMMAR.arcs[state, symbol]
        if reading:
            sums[reading] += weight
            if reading not in ("targeted", "threat"):
                top = max(top, weight)
    return top


def unit_features(b: np.ndarray, offs: np.ndarray):
    """(starts, ends, units per row, [hashes of the whole units, then of each prefix length; 0 where there is none])."""
    b = lowered(b)
    starts, ends, per_row = units(b, offs)
    out = [span_hash(b, starts, ends, lower=False)]
    for k in PREFIXES:
        longer = ends - starts > k
        out.append(np.where(longer, mix(span_hash(b, starts, np.minimum(ends, starts + k), lower=False) + U(k)), U(0)))
    return starts, ends, per_row, out


class Lexicon:
    """Learned weights by feature hash, looked up through a bit table first."""

    def __init__(self, learned: dict[int, float]):
        both = {_word_hash(w): GENERAL for w in INSULTS} | {k & (1 << 64) - 1: v for k, v in learned.items()}
        self.keys = np.array(sorted(both), np.uint64)
        self.weights = np.array([both[int(k)] for k in self.keys], np.float64)
        self.maybe = np.zeros(1 << 16, bool)
        self.maybe[(self.keys & U(0xFFFF)).astype(np.int64)] = True

    def look(self, h: np.ndarray) -> np.ndarray:
        out = np.zeros(len(h))
        at = np.flatnonzero(self.maybe[(h & U(0xFFFF)).astype(np.int64)])
        if len(at):
            place = np.minimum(np.searchsorted(self.keys, h[at]), len(self.keys) - 1)
            out[at] = np.where(self.keys[place] == h[at], self.weights[place], 0.0)
        return out


_LISTED = {h: kind for kind, words in LISTS.items() for h in words}
_LISTED_KEYS = np.array(sorted(_LISTED), np.uint64)
_LISTED_KIND = np.array([SYMBOLS.index(_LISTED[int(h)]) for h in _LISTED_KEYS], np.uint8)
_LISTED_MAYBE = np.zeros(1 << 16, bool)
_LISTED_MAYBE[(_LISTED_KEYS & U(0xFFFF)).astype(np.int64)] = True
#: The composed machine as arrays: next state and reading (-1: none) by state and symbol; the start is state 0.
_NUMBER = {state: k for k, state in enumerate(dict.fromkeys([GRAMMAR.start, *(state for state, _ in GRAMMAR.arcs)]))}
_NEXT = np.array([[_NUMBER[GRAMMAR.arcs[state, x][0]] for x in SYMBOLS] for state in _NUMBER], np.int64)
_READS = np.array([[READINGS.index(r) if (r := GRAMMAR.arcs[state, x][1]) else -1 for x in SYMBOLS] for state in _NUMBER], np.int64)
FOUND = len(READINGS) + 2  # a row of findings: the sum of each reading, the strongest event without aim, the units


def symbols_of(whole: np.ndarray, weight: np.ndarray) -> np.ndarray:
    """The symbol of each unit, as its place in SYMBOLS, from the hash of the whole unit and its lexical weight."""
    out = np.full(len(whole), SYMBOLS.index(WORD), np.uint8)
    at = np.flatnonzero(_LISTED_MAYBE[(whole & U(0xFFFF)).astype(np.int64)])
    place = np.minimum(np.searchsorted(_LISTED_KEYS, whole[at]), len(_LISTED_KEYS) - 1)
    known = _LISTED_KEYS[place] == whole[at]
    out[at[known]] = _LISTED_KIND[place[known]]
    out[weight > 0] = SYMBOLS.index(INSULT)
    return out


def events(symbol: np.ndarray, first: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(unit, reading) of every event; ``first`` marks the first unit of each clause.

    All clauses that hold an insult or a threat verb are read at once, unit by unit, the longest first.
    """
    begin = np.flatnonzero(first)
    clause = np.cumsum(first) - 1
    held = np.unique(clause[symbol <= SYMBOLS.index(THREAT)])
    size = np.diff(np.append(begin, len(symbol)))[held]
    order = np.argsort(-size, kind="stable")
    begin, size = begin[held][order], size[order]
    state, units_found, readings = np.zeros(len(size), np.int64), [], []
    active = len(size) - np.searchsorted(size[::-1], np.arange(int(size[0]) if len(size) else 0), "right")
    for t, n in enumerate(active.tolist()):
        at = begin[:n] + t
        x = symbol[at]
        reading = _READS[state[:n], x]
        state[:n] = _NEXT[state[:n], x]
        hit = np.flatnonzero(reading >= 0)
        if len(hit):
            units_found.append(at[hit])
            readings.append(reading[hit])
    if not units_found:
        return np.zeros(0, np.int64), np.zeros(0, np.int64)
    return np.concatenate(units_found), np.concatenate(readings)


def findings(b: np.ndarray, offs: np.ndarray, lexicon: Lexicon) -> np.ndarray:
    """The findings of each row."""
    starts, ends, per_row, feats = unit_features(b, offs)
    out = np.zeros((len(offs) - 1, FOUND))
    out[:, -1] = per_row
    if not len(starts):
        return out
    weight = lexicon.look(feats[0])
    for h in feats[1:]:
        weight = np.maximum(weight, lexicon.look(h))
    stops = np.zeros(256, bool)
    stops[list(b".!?;:\n")] = True
    # A clause ends with its row, or at a mark or line break between two units: count such bytes up to each unit's start.
    marks = np.concatenate(([0], np.cumsum(stops[b])))[starts]
    row = np.repeat(np.arange(len(per_row)), per_row)
    first = np.ones(len(starts), bool)
    first[1:] = (marks[1:] != marks[:-1]) | (row[1:] != row[:-1])
    at, reading = events(symbols_of(feats[0], weight), first)
    own = np.where(weight[at] > 0, weight[at], GENERAL)
    n = len(READINGS)
    out[:, :n] = np.bincount(row[at] * n + reading, own, len(per_row) * n).reshape(-1, n)
    aimless = ~np.isin(reading, [READINGS.index(k) for k in ("targeted", "threat")])
    np.maximum.at(out[:, -2], row[at][aimless], own[aimless])
    return out


def _count_features(batches):
    """(feature, fold, toxic documents, documents) per batch: each feature once a document."""
    for batch in batches:
        b, offs = text_buffers(batch.column("text"))
        toxic, fold = batch.column("toxic").to_numpy(), batch.column("fold").to_numpy()
        for i, j in row_chunks(offs):
            _, _, per_row, feats = unit_features(b[offs[i] : offs[j]], offs[i : j + 1] - offs[i])
            row, h = np.tile(np.repeat(np.arange(j - i), per_row), len(feats)), np.concatenate(feats)
            u, back = np.unique(h[h != 0], return_inverse=True)
            pair = np.unique(back * (j - i) + row[h != 0])
            feature, doc = pair // (j - i), pair % (j - i)
            key = feature * FOLDS + fold[i:j][doc]
            n, t = np.bincount(key, minlength=len(u) * FOLDS), np.bincount(key, toxic[i:j][doc], minlength=len(u) * FOLDS)
            at = np.flatnonzero(n)
            yield pa.RecordBatch.from_arrays([pa.array(u[at // FOLDS].view(np.int64)), pa.array((at % FOLDS).astype(np.int32)), pa.array(t[at].astype(np.int64)), pa.array(n[at].astype(np.int64))], ["feature", "fold", "t", "n"])


def _families(batches):
    """Adds the family of each text, the smallest hash of its five-word shingles: near copies mostly share it."""
    for batch in batches:
        b, offs = text_buffers(batch.column("text"))
        family = np.zeros(len(batch), np.uint64)
        for i, j in row_chunks(offs):
            own, at = b[offs[i] : offs[j]], offs[i : j + 1] - offs[i]
            starts, ends, counts = word_spans(own, at)
            h, row = shingles(span_hash(own, starts, ends), counts)
            some = np.flatnonzero(counts)
            family[i + some] = np.minimum.reduceat(h, np.searchsorted(row, some)) if len(some) else 0
        yield pa.RecordBatch.from_arrays([batch.column("text"), batch.column("toxic"), pa.array(family.view(np.int64))], ["text", "toxic", "family"])


def _sample_findings(lexica: list[dict[int, float]]):
    """The findings of the sample's rows, each by the lexicon that its fold did not teach."""

    def run(batches):
        looked = [Lexicon(x) for x in lexica]
        for batch in batches:
            for k, lexicon in enumerate(looked):
                part = batch.filter(pa.array(batch.column("fold").to_numpy() == k))
                b, offs = text_buffers(part.column("text"))
                for i, j in row_chunks(offs):
                    s = findings(b[offs[i] : offs[j]], offs[i : j + 1] - offs[i], lexicon)
                    yield pa.RecordBatch.from_arrays([part.column("toxic").slice(i, j - i), ragged(s.ravel(), np.full(len(s), FOUND), pa.float64())], ["toxic", "found"])

    return run


def _weights(t: np.ndarray, n: np.ndarray, pos: int, neg: int, evidence: float) -> np.ndarray:
    """Log-odds less one standard error of features in t toxic of n documents; 0 without enough evidence."""
    c, p = n - t, pos / (pos + neg)
    with np.errstate(divide="ignore", invalid="ignore"):
        ratio = np.where(t > 0, t * np.log(t / (n * p)), 0.0) + np.where(c > 0, c * np.log(c / (n * (1 - p))), 0.0)
    w = np.log((t + 0.5) / (pos + 1)) - np.log((c + 0.5) / (neg + 1)) - np.sqrt(1 / (t + 0.5) + 1 / (c + 0.5))
    return np.where((ratio >= evidence) & (t > 0), np.maximum(w, 0), 0.0)


def inputs(found: np.ndarray, factors: dict[str, float]) -> np.ndarray:
    """The logistic layer's inputs: log strength, log strength per hundred units, and 1."""
    strength = np.maximum(found[:, : len(READINGS)] @ [factors[k] for k in READINGS] - found[:, -2], 0)
    strength = np.where(strength < 1e-9, 0, strength)
    return np.stack((np.log1p(strength), np.log1p(100 * strength / (found[:, -1] + 20)), np.ones(len(found))), axis=1)


def _logistic(x: np.ndarray, y: np.ndarray, ridge: float = 0.5, turns: int = 100) -> tuple[np.ndarray, float]:
    """(coefficients, loss) of a logistic layer with a ridge towards DEFAULT, by Newton steps.

    Strength never counts against a text: an input that would is left out and the others are fitted anew.
    """
    use, prior, penalty = np.ones(x.shape[1], bool), np.array(DEFAULT), np.array([ridge] * (x.shape[1] - 1) + [1e-3])
    while True:
        w = np.where(use, prior, 0.0)
        a = x * use
        for _ in range(turns):
            p = 1 / (1 + np.exp(-np.clip(a @ w, -30, 30)))
            step = np.linalg.solve(a.T @ (a * (p * (1 - p))[:, None]) + np.diag(penalty), a.T @ (p - y) + penalty * (w - prior) * use)
            w = w - np.clip(step, -2, 2)
            if np.abs(step).max() < 1e-6:
                break
        against = use & (w < 0)
        against[-1] = False
        if not against.any():
            z = np.clip(a @ w, -30, 30)
            return w, float((np.log1p(np.exp(z)) - y * z).sum() + 0.5 * (penalty * (w - prior) ** 2).sum())
        use &= ~against


class Model:
    def __init__(self, learned: dict[int, float], factors: dict[str, float], coefficients: list[float]):
        self.learned, self.factors, self.coefficients = learned, factors, coefficients

    def scores(self, found: np.ndarray) -> np.ndarray:
        z = inputs(found, self.factors) @ np.array(self.coefficients)
        return 1 / (1 + np.exp(-np.clip(z, -30, 30)))


def calibrate(found: np.ndarray, toxic: np.ndarray) -> tuple[dict[str, float], np.ndarray]:
    """(factors, coefficients) of the least loss over findings of unseen rows."""
    best = None
    for chosen in product(*CHOICES.values()):
        factors = FACTORS | dict(zip(CHOICES, chosen, strict=True))
        w, loss = _logistic(inputs(found, factors), toxic)
        loss += sum(np.log(factors[k] / FACTORS[k]) ** 2 for k in CHOICES)
        if best is None or loss < best[0] - 1e-9:
            best = loss, factors, w
    return best[1], best[2]


def train(docs: DataFrame, labels: DataFrame, sample: int = 8000, entries: int = 5000, evidence: float = 10.0) -> Model:
    """Learns lexicon, factors and calibration. ``sample``: most toxic rows (clean ones: twice that); ``entries``: most features.

    A feature that speaks for toxicity enters when its log-likelihood ratio against the base rate reaches ``evidence``. Its
    weight is its log-odds less one standard error, so that features of few documents weigh less.
    """
    ws = Workspace(docs.sparkSession, "toxicity")
    rows = labels.where(F.col("toxic").isNotNull()).where(crc_mod(F.col("doc_id"), 5) != 0).groupBy("doc_id").agg(F.max(F.col("toxic").cast("int")).alias("toxic"))
    pick = [rows.where(F.col("toxic") == y).orderBy(F.xxhash64("doc_id"), "doc_id").limit(k) for y, k in ((1, sample), (0, 2 * sample))]
    chosen = ws.keep(pick[0].unionByName(pick[1]), "chosen")  # at most 3 * sample narrow rows: bounded, so broadcast
    texts = docs.select("doc_id", F.col("text").cast("string").alias("text")).join(F.broadcast(chosen), "doc_id")
    # One text of each family, and families whole in a fold: copies would make evidence of every word they hold.
    texts = texts.select("text", "toxic").mapInArrow(_families, "text string, toxic int, family long")
    texts = texts.groupBy("family", "toxic").agg(F.max("text").alias("text"))
    texts = ws.keep(texts.select("text", "toxic", F.pmod(F.xxhash64("family"), F.lit(FOLDS)).cast("int").alias("fold")), "texts")
    sizes = {(r["toxic"], r["fold"]): r["count"] for r in texts.groupBy("toxic", "fold").count().collect()}
    per = {y: np.array([sizes.get((y, k), 0) for k in range(FOLDS)]) for y in (0, 1)}
    pos, neg = int(per[1].sum()), int(per[0].sum())
    if not pos or not neg:
        return Model({}, FACTORS, DEFAULT)
    counts = texts.mapInArrow(_count_features, "feature long, fold int, t long, n long").groupBy("feature")
    by_fold = [F.sum(F.when(F.col("fold") == k, F.col(c)).otherwise(0)).alias(f"{c}{k}") for c in "tn" for k in range(FOLDS)]
    counts = counts.agg(F.sum("t").alias("t"), F.sum("n").alias("n"), *by_fold).where(F.col("t") > 0)
    c, p = F.col("n") - F.col("t"), pos / (pos + neg)
    ratio = F.col("t") * F.log(F.col("t") / (F.col("n") * p)) + F.when(c > 0, c * F.log(c / (F.col("n") * (1 - p)))).otherwise(0.0)
    # Folds left out lower a ratio or raise it a little; half the evidence keeps every feature that some lexicon may admit.
    top = counts.where(F.col("t") > F.col("n") * p).where(ratio >= evidence / 2).orderBy(F.desc(ratio), "feature").limit(entries).toArrow()
    feature, t, n = (top.column(k).to_numpy() for k in ("feature", "t", "n"))
    lexica = []
    for k in range(FOLDS):
        w = _weights(t - top.column(f"t{k}").to_numpy(), n - top.column(f"n{k}").to_numpy(), pos - int(per[1][k]), neg - int(per[0][k]), evidence * (1 - 1 / FOLDS))
        lexica.append(dict(zip(feature[w > 0].tolist(), w[w > 0].tolist(), strict=True)))
    found = texts.mapInArrow(_sample_findings(lexica), "toxic int, found array<double>").collect()
    x, y = np.array([r["found"] for r in found]), np.array([r["toxic"] for r in found], float)
    factors, coefficients = calibrate(x, y)
    every = {r["toxic"]: r["count"] for r in rows.groupBy("toxic").count().collect()}
    coefficients[-1] += np.log(every[1] / every[0]) - np.log(pos / neg)  # the sample holds more toxic rows than the labels do
    # A text without findings, or with one isolated word, is never toxic by itself.
    coefficients[-1] = min(coefficients[-1], -1.0)
    w = _weights(t, n, pos, neg, evidence)
    return Model(dict(zip(feature[w > 0].tolist(), w[w > 0].tolist(), strict=True)), factors, coefficients.tolist())


def _scorer(model: Model, least: float | None):
    """Appends the score to batches of (doc_id, text); with ``least`` yields the rows below it unchanged instead."""

    def run(batches):
        lexicon = Lexicon(model.learned)
        for batch in batches:
            b, offs = text_buffers(batch.column("text"))
            for i, j in row_chunks(offs, 4 << 20):
                s = [model.scores(findings(b[offs[k] : offs[m]], offs[k : m + 1] - offs[k], lexicon)) for k, m in ((i + x, i + y) for x, y in row_chunks(offs[i : j + 1] - offs[i]))]
                score, part = np.concatenate(s), batch.slice(i, j - i)
                if least is None:
                    yield pa.RecordBatch.from_arrays([part.column("doc_id"), pa.array(score)], ["doc_id", "score"])
                else:
                    yield part.filter(pa.array(score < least))

    return run


def toxicity(docs: DataFrame, labels: DataFrame, sample: int = 8000) -> DataFrame:
    """(doc_id, held_out, score, predicted) of every row."""
    docs = rows_of(docs)
    scored = docs.mapInArrow(_scorer(train(docs, labels, sample), None), "doc_id long, score double")
    return scored.select("doc_id", (crc_mod(F.col("doc_id"), 5) == 0).alias("held_out"), "score", (F.col("score") >= 0.5).cast("int").alias("predicted"))


def without_toxic(docs: DataFrame, labels: DataFrame, least: float = 0.5, sample: int = 8000) -> DataFrame:
    """The rows of ``docs`` that score below ``least``, with their columns."""
    return docs.mapInArrow(_scorer(train(docs, labels, sample), least), docs.schema)
