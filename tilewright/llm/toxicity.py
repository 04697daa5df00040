"""Toxicity by a weighted finite-state grammar over clauses.

A word transducer maps words to symbols: insults and threats with a strength, targets,
intentions, negations and reporting verbs. A rewriting pass marks what a later report covers
and takes the reporter out of the targets. Transducers for negation, reported speech, targets
and intentions then read the symbols of a clause and scale what the insult and threat
transducer puts out; they are composed into one automaton, which scores each matched clause.
Quoted speech runs on over the clauses of a paragraph. A document's strongest clause and the sum
of its clauses give its score by a logistic curve. Insult and threat stems, their strengths and
the curve are learned from labelled texts; the closed word classes are given.
"""

from __future__ import annotations

import math
import re
from collections import Counter

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, functions as F

from .common import materialize, slices

#: Closed word classes (given, not learned), in four languages.
TARGETS = "you your you're yours u he she they them him her his their people du dich dir ihr euch sie dein deine tu te toi vous ton ta votre vos tú usted ustedes vosotros os tu tus su".split()
NEGATIONS = "not no never n't isn't aren't don't doesn't wasn't nicht kein keine keinen nie niemals pas jamais aucun aucune nunca jamás ningún ninguna".split()
REPORTS = "said says say called calls wrote reported quoted claims sagte sagt schrieb nannte dit écrit appelé appelle dijo dice escribió llamó".split()
INTENTIONS = "will i'll we'll gonna going want wants shall should must werde werden wirst wollen muss vais allons va veux doit voy vamos va quiero debe".split()
THREATS = "kill hurt destroy murder stab strangle töten umbringen verprügeln tuer frapper égorger matar golpear apuñalar".split()
INSULTS = "idiot moron loser".split()
PRIOR_INSULT, PRIOR_THREAT = 3.0, 2.0

_TOKEN = re.compile(r"[^\W\d_]+(?:['’][^\W\d_]+)*|[.!?;:,\n…]|[\"“”„«»]")
OTHER, CLAUSE, QUOTE, NEGATION, REPORT, TARGET, INTENTION = b"o", b".", b'"', b"n", b"r", b"y", b"w"
PARAGRAPH, COMMA, COLON, COVERED, FREE = b"\n", b",", b":", b"(", b")"
INSULT_LEVELS, THREAT_LEVELS = b"12345678", b"ABCDEFGH"
_HIT = re.compile(b"[1-8A-H]")
#: How many words a frame spans: between a report and what it reports, or an intention, a threat and its target.
REACH = 3
SHORTEST, LONGEST = 4, 8
#: Entries that a task counts before it hands them on, and words that it remembers.
ENTRIES, WORDS = 100_000, 200_000


# --- the grammar -----------------------------------------------------------------------------


class Transducer:
    """States, and for each state and symbol the next state, a factor and an addition to the output."""

    def __init__(self, start, step):
        self.start, self.step = start, step


MARKS = COMMA + COVERED + FREE


def _negation(state: int, symbol: int):
    if symbol in MARKS:
        return state, 1.0, 0.0
    if symbol == NEGATION[0]:
        return 3, 1.0, 0.0
    return max(0, state - 1), 0.25 if state else 1.0, 0.0


def _reported(state: tuple[bool, bool, bool], symbol: int):
    """state: within quotes, behind a reporting verb, covered by a later one."""
    quoted, verb, covered = state
    if symbol == QUOTE[0]:
        quoted = not quoted
    elif symbol == REPORT[0]:
        verb = True
    elif symbol in COVERED + FREE:
        covered = symbol == COVERED[0]
    return (quoted, verb, covered), 0.5 if any(state) else 1.0, 0.0


def _targeted(state: tuple[int, int], symbol: int):
    """state: words since a target and since an insult or threat, 4 for none near."""
    near, struck = state
    if symbol in MARKS:
        return state, 1.0, 0.0
    hit = symbol in INSULT_LEVELS or symbol in THREAT_LEVELS
    follows = symbol == TARGET[0] and struck < 4
    after = (0 if symbol == TARGET[0] else min(4, near + 1), 0 if hit else min(4, struck + 1))
    threat_alone = symbol in THREAT_LEVELS and near >= 4
    return after, 0.5 if threat_alone else 1.25 if hit and near < 4 else 1.0, 0.5 if follows else 0.0


def _intended(state: int, symbol: int):
    """state: words that an intention still reaches."""
    if symbol in MARKS:
        return state, 1.0, 0.0
    if symbol == INTENTION[0]:
        return REACH, 1.0, 0.0
    return max(0, state - 1), 1.5 if state and symbol in THREAT_LEVELS else 1.0, 0.0


def _strength(symbol: int) -> float:
    if symbol in INSULT_LEVELS:
        return 1.0 + INSULT_LEVELS.index(symbol)
    if symbol in THREAT_LEVELS:
        return 1.0 + THREAT_LEVELS.index(symbol)
    return 0.0


NEGATED, TARGETED, INTENDED = Transducer(0, _negation), Transducer((4, 4), _targeted), Transducer(0, _intended)
SPOKEN, IN_QUOTES = Transducer((False, False, False), _reported), Transducer((True, False, False), _reported)


def compose(*starts: tuple[Transducer, ...]) -> list[dict[int, tuple[int, float]]]:
    """The product automaton: for each state and symbol the next state and the output weight.

    starts are the same transducers from different starting states; state i is the i-th start.
    The insult and threat transducer is the innermost: its strength is multiplied by all
    factors; additions are scaled by the factors too.
    """
    symbols = OTHER + QUOTE + NEGATION + REPORT + TARGET + INTENTION + MARKS + INSULT_LEVELS + THREAT_LEVELS
    todo = [tuple(p.start for p in parts) for parts in starts]
    numbers, table, parts = {s: i for i, s in enumerate(todo)}, [], starts[0]
    while todo:
        state, arcs = todo.pop(0), {}
        for symbol in symbols:
            steps = [p.step(s, symbol) for p, s in zip(parts, state)]
            factor = math.prod(f for _, f, _ in steps)
            after = tuple(s for s, _, _ in steps)
            if after not in numbers:
                numbers[after] = len(numbers)
                todo.append(after)
            arcs[symbol] = numbers[after], factor * (_strength(symbol) + sum(x for _, _, x in steps))
        table.append(arcs)
    return table


GRAMMAR = compose((NEGATED, SPOKEN, TARGETED, INTENDED), (NEGATED, IN_QUOTES, TARGETED, INTENDED))
_REPORTER = re.compile(b"y(?=r)")
_INTRODUCED = re.compile(b"(r[^.:,\"]{0,%d}):" % REACH)
_LATER = re.compile(b",[^.,\"1-8A-H]{0,%d}?r" % REACH)


def rewrite(paragraph: bytes) -> list[tuple[bytes, bool]]:
    """The clauses of a paragraph's symbols, each with whether it begins within quotes.

    A quotation mark without a partner in the paragraph is dropped. A colon behind a reporting
    verb goes on with its clause, other colons end it. A target right before a reporting verb is
    the reporter and no target. What stands before a comma and a reporting verb is covered.
    """
    if paragraph.count(QUOTE) % 2:
        before, _, after = paragraph.rpartition(QUOTE)
        paragraph = before + after
    paragraph = _REPORTER.sub(OTHER, paragraph)
    if COLON in paragraph:
        paragraph = _INTRODUCED.sub(b"\\1", paragraph).replace(COLON, CLAUSE)
    out, quoted = [], False
    for clause in paragraph.split(CLAUSE):
        later = _LATER.search(clause) if REPORT in clause else None
        out.append((COVERED + clause[: later.start()] + FREE + clause[later.start() :] if later else clause, quoted))
        quoted ^= clause.count(QUOTE) % 2 == 1
    return out


def clause_score(symbols: bytes, quoted: bool = False) -> float:
    state, score = int(quoted), 0
    for symbol in symbols:
        state, weight = GRAMMAR[state][symbol]
        score += weight
    return score


# --- words to symbols ------------------------------------------------------------------------


class Lexicon:
    """Weighted stems (`stem` fits every word that begins with it, `=word` that word only); those in threats are threats, the others insults."""

    def __init__(self, weights: dict[str, float], threats: frozenset[str] = frozenset()):
        self.stems = {**{"=" + w: PRIOR_INSULT for w in INSULTS}, **{"=" + w: PRIOR_THREAT for w in THREATS}, **weights}
        self.threats = {"=" + w for w in THREATS} | threats
        closed = ((TARGETS, TARGET), (INTENTIONS, INTENTION), (NEGATIONS, NEGATION), (REPORTS, REPORT))
        self.classes = {w: s for words, s in closed for w in words}
        self.known: dict[str, bytes] = {}

    def symbol(self, word: str) -> bytes:
        for entry in ("=" + word, *(word[:n] for n in range(min(LONGEST, len(word)), SHORTEST - 1, -1))):
            weight = self.stems.get(entry)
            if weight is not None:
                n = min(8, max(1, round(weight)))
                return (THREAT_LEVELS if entry in self.threats else INSULT_LEVELS)[n - 1 : n]
        return self.classes.get(word, OTHER)

    def symbols(self, text: str) -> bytes:
        parts = text.split(" ")
        try:
            return b"".join(map(self.known.__getitem__, parts))
        except KeyError:
            if len(self.known) > WORDS:
                self.known.clear()
            for p in set(parts):
                if p not in self.known:
                    self.known[p] = b"".join(self._token(t) for t in _TOKEN.findall(p.lower()))
            return b"".join(map(self.known.__getitem__, parts))

    def _token(self, token: str) -> bytes:
        if token[0].isalpha():
            return self.symbol(token.replace("’", "'"))
        if token in '"“”„«»':
            return QUOTE
        return token.encode() if token in ",:\n" else CLAUSE

    def features(self, text: str) -> tuple[float, float, int]:
        """The strongest clause's score, the sum over clauses, and the number of matched clauses."""
        symbols = self.symbols(text)
        if not _HIT.search(symbols):
            return 0.0, 0.0, 0
        paragraphs = [p for p in symbols.split(PARAGRAPH) if _HIT.search(p)]
        scores = [clause_score(c, quoted) for p in paragraphs for c, quoted in rewrite(p) if _HIT.search(c)]
        return max(scores), sum(scores), len(scores)


# --- learning --------------------------------------------------------------------------------


def _entries(word: str) -> list[str]:
    return ["=" + word, *(word[:n] for n in range(SHORTEST, min(LONGEST, len(word)) + 1))]


def stems(text: str, among: frozenset[str] | None = None) -> tuple[set[str], set[str]]:
    """What a text offers as lexicon entries, its words and the beginnings of its words, and which of them stand in a threat's frame.

    Words of the closed classes are no entries. With among, only entries in it, and no frames.
    The frame is an intention up to REACH words before and a target up to REACH words behind.
    """
    words = [t.replace("’", "'") for t in _TOKEN.findall(text.lower()) if t[0].isalpha()]
    found, framed = {e for word in set(words) - _CLOSED for e in _entries(word) if among is None or e in among}, set()
    if among is not None:
        return found, framed
    for i, word in enumerate(words):
        if word in _INTENDING:
            for j in range(i + 1, min(len(words), i + 1 + REACH)):
                if words[j] not in _CLOSED and not _TARGETED.isdisjoint(words[j + 1 : j + 1 + REACH]):
                    framed.update(_entries(words[j]))
    return found, framed


_INTENDING, _TARGETED = frozenset(INTENTIONS), frozenset(TARGETS)
_CLOSED = frozenset(TARGETS + NEGATIONS + REPORTS + INTENTIONS)


class Model:
    """A lexicon (weights of stems, and which are threats) and the logistic curve (bias, weight of the strongest clause, weight of log(1 + sum))."""

    def __init__(self, weights: dict[str, float], curve: tuple[float, float, float], threats: frozenset[str] = frozenset()):
        self.weights, self.curve, self.threats = weights, curve, threats


DEFAULT_CURVE = (-3.0, 1.0, 1.0)


def _rows(batches, *columns: str):
    """Rows of record batches as tuples; the last column is text, of which a few megabytes are taken at a time."""
    for batch in batches:
        for lo, hi in slices(pc.fill_null(pc.binary_length(batch.column(columns[-1])), 0).to_pylist(), 2 << 20):
            yield from zip(*(batch.column(c)[lo:hi].to_pylist() for c in columns))


def _fit(x: np.ndarray, y: np.ndarray, penalty: float = 1e-2) -> tuple[float, float, float]:
    """Logistic regression by Newton's method; both classes must occur."""
    a = np.column_stack([np.ones(len(x)), x[:, 0], np.log1p(x[:, 1])])
    w = np.zeros(3)
    for _ in range(50):
        p = 1 / (1 + np.exp(-np.clip(a @ w, -30, 30)))
        step = np.linalg.solve((a * (p * (1 - p))[:, None]).T @ a + penalty * np.eye(3), a.T @ (y - p) - penalty * w)
        w += step
        if np.abs(step).max() < 1e-8:
            break
    return tuple(w.tolist())


def _cover(owner: np.ndarray, entry: np.ndarray, n_entries: int, n_texts: int, least: int) -> list[int]:
    """Entries that one after another explain most texts not yet explained, `least` texts at least each; of equal ones the first.

    owner and entry are the pairs of a text and an entry that it holds, ordered by text.
    """
    begins = np.searchsorted(owner, np.arange(n_texts + 1))
    by_entry = np.argsort(entry, kind="stable")
    first = np.searchsorted(entry[by_entry], np.arange(n_entries + 1))
    gain, open_, chosen = np.bincount(entry, minlength=n_entries), np.ones(n_texts, bool), []
    while len(gain) and gain.max() >= least:
        best = int(gain.argmax())
        chosen.append(best)
        texts = owner[by_entry[first[best] : first[best + 1]]]
        for t in texts[open_[texts]]:
            gain[entry[begins[t] : begins[t + 1]]] -= 1
        open_[texts] = False
    return chosen


def learn(
    docs: DataFrame,
    labels: DataFrame,
    train: Column | None = None,
    max_rows: int = 20_000,
    least: int = 3,
    id_col: str = "doc_id",
    text_col: str = "text",
    label_col: str = "toxic",
) -> Model:
    """A model from the labelled rows for which train (a Column over labels) holds.

    At most max_rows labelled rows are used, those with the smallest hash of their id; nothing
    else is left out. Of entries that the same texts hold, one can explain no more than another,
    so only the best of them comes to the driver with the numbers of the texts that hold it.
    What the driver holds, entries of at least `least` of the sample's toxic texts and these
    numbers, is bounded by the sample, whatever the size of docs. Entries that mostly stand in a threat's frame become threats. Each distinct text counts
    once, so groups of copies do not weigh more. An id with several labels is toxic if any is;
    null ids and labels are left out. Without rows of both classes the given words and
    DEFAULT_CURVE remain.
    """
    some = labels.where(F.col(id_col).isNotNull() & F.col(label_col).isNotNull())
    some = some.where(train) if train is not None else some
    some = some.groupBy(F.col(id_col).alias("__id")).agg(F.max(label_col).alias("__label")).orderBy(F.xxhash64("__id"), "__id").limit(max_rows)
    rows = docs.join(F.broadcast(some), F.col(id_col) == F.col("__id")).where(F.col(text_col).isNotNull())  # max_rows bounds the broadcast
    rows = rows.select(F.col(text_col).alias("text"), F.col("__label").cast("int").alias("label"))
    rows = materialize(rows.groupBy(F.xxhash64("text").alias("h")).agg(F.first("text").alias("text"), F.max("label").alias("label")), "labelled")
    size = {r["label"]: r["count"] for r in rows.groupBy("label").count().collect()}
    n_pos, n_neg = size.get(1, 0), size.get(0, 0)
    if not n_pos or not n_neg:
        return Model({}, DEFAULT_CURVE)

    def held_by_toxic(batches):
        pos, framed, which = Counter(), Counter(), {}

        def flush():
            names = list(pos)
            columns = [pa.array(v, pa.int64()) for v in (list(pos.values()), [framed[s] for s in names], [which[s] for s in names])]
            for kept in (pos, framed, which):
                kept.clear()
            return pa.RecordBatch.from_arrays([pa.array(names, pa.string()), *columns], ["stem", "pos", "framed", "texts"])

        for h, text in _rows(batches, "h", "text"):
            found, in_frame = stems(text)
            pos.update(found)
            framed.update(in_frame)
            for s in found:
                which[s] = which.get(s, 0) ^ h
            if len(pos) > ENTRIES:
                yield flush()
        yield flush()

    toxic, clean = rows.where("label = 1"), rows.where("label = 0")
    counts = toxic.select("h", "text").mapInArrow(held_by_toxic, "stem string, pos bigint, framed bigint, texts bigint")
    counts = counts.groupBy("stem").agg(F.sum("pos").alias("pos"), F.sum("framed").alias("framed"), F.bit_xor("texts").alias("texts"))
    counts = materialize(counts.where(f"pos >= {least}"), "stems")
    asked = frozenset(counts.select("stem").toArrow().column("stem").to_pylist())

    def held_by_clean(batches):
        neg = Counter()
        for (text,) in _rows(batches, "text"):
            neg.update(stems(text, asked)[0])
        yield pa.RecordBatch.from_arrays([pa.array(list(neg), pa.string()), pa.array(list(neg.values()), pa.int64())], ["stem", "neg"])

    against = clean.select("text").mapInArrow(held_by_clean, "stem string, neg bigint").groupBy("stem").agg(F.sum("neg").alias("neg"))
    counts = counts.withColumn("neg", F.lit(0).cast("bigint")).unionByName(against, allowMissingColumns=True).groupBy("stem")
    counts = counts.agg(F.sum("neg").alias("neg"), *[F.max(c).alias(c) for c in ("pos", "framed", "texts")])
    odds = F.log((F.col("pos") + 0.5) / (n_pos + 1)) - F.log((F.col("neg") + 0.5) / (n_neg + 1))
    counts = materialize(counts.withColumn("odds", odds).where("odds >= 2"), "odds")
    # entries with the same count and the same combined hash of their texts are held by the same texts
    rank = F.struct((-F.col("odds")).alias("odds"), (-F.col("framed")).alias("framed"), F.length("stem").alias("size"), "stem")
    best = counts.groupBy("pos", "texts").agg(F.min(rank).alias("best"))
    best = best.select("best.stem", (-F.col("best.odds")).alias("odds"), "pos", (-F.col("best.framed")).alias("framed"))
    found = best.orderBy(F.desc("odds"), F.desc("framed"), F.length("stem"), "stem").collect()
    place = {r["stem"]: i for i, r in enumerate(found)}
    wanted = frozenset(place)

    def held(batches):
        for batch in batches:
            kept = [sorted(place[s] for s in stems(t, wanted)[0]) for (t,) in _rows([batch], "text")]
            yield pa.RecordBatch.from_arrays([pa.array(kept, pa.list_(pa.int32()))], ["entries"])

    lists = rows.where("label = 1").select("text").mapInArrow(held, "entries array<int>").toArrow().column("entries").combine_chunks()
    owner = np.repeat(np.arange(len(lists)), np.diff(lists.offsets.to_numpy())) if len(lists) else np.zeros(0, np.int64)
    chosen = [found[i] for i in _cover(owner, lists.flatten().to_numpy(), len(found), len(lists), least)]
    weights, threats = {r["stem"]: r["odds"] for r in chosen}, {r["stem"] for r in chosen if 2 * r["framed"] > r["pos"]}
    # and those that stand for toxicity by themselves, though other entries explain their texts too
    for r in counts.where((F.col("odds") >= 5.5) & (F.col("pos") >= max(5, 0.02 * n_pos))).orderBy(F.desc("pos"), "stem").collect():
        word = r["stem"].lstrip("=")
        if "=" + word not in weights and not any(word[:n] in weights for n in range(SHORTEST, len(word) + 1)):
            weights[r["stem"]] = r["odds"]
            threats |= {r["stem"]} if 2 * r["framed"] > r["pos"] else set()
    model = Model(weights, DEFAULT_CURVE, frozenset(threats))
    scored = score(rows.select("text", "label"), model, "text").select("strongest", "total", "label").toPandas()
    return Model(weights, _fit(scored[["strongest", "total"]].to_numpy(), scored["label"].to_numpy()), model.threats)


def score(docs: DataFrame, model: Model, text_col: str = "text", keep_text: bool = False) -> DataFrame:
    """docs' columns but the text, with strongest, total, clauses (what matched) and score (0 to 1).

    Whole texts are read. A null or empty text, or one without a match, has the score that the
    curve gives to no match. Repeated rows are scored each; columns of docs that are named like
    one of the new ones are replaced; an empty table stays empty. With keep_text the text is
    among the columns.
    """
    weights, curve, threats = model.weights, model.curve, model.threats
    made = ["strongest", "total", "clauses", "score"]
    own = [c for c in docs.columns if c not in made and (keep_text or c != text_col)]
    kept = docs.select(*own, *([] if text_col in own else [text_col]))

    def run(batches):
        lexicon = Lexicon(weights, threats)
        for batch in batches:
            texts = batch.column(text_col)
            for lo, hi in slices(pc.fill_null(pc.binary_length(texts), 0).to_pylist(), 4 << 20):
                found = np.array([lexicon.features(t) if t else (0.0, 0.0, 0) for t in texts[lo:hi].to_pylist()], float).reshape(-1, 3)
                z = curve[0] + curve[1] * found[:, 0] + curve[2] * np.log1p(found[:, 1])
                values = [pa.array(found[:, 0]), pa.array(found[:, 1]), pa.array(found[:, 2].astype(np.int64)), pa.array(1 / (1 + np.exp(-np.clip(z, -30, 30))))]
                yield pa.RecordBatch.from_arrays([*(batch.column(c)[lo:hi] for c in own), *values], [*own, *made])

    fields = "".join(f"`{f.name}` {f.dataType.simpleString()}, " for f in kept.schema if f.name in own)
    return kept.mapInArrow(run, fields + "strongest double, total double, clauses bigint, score double")


def reject_toxic(docs: DataFrame, model: Model, limit: float = 0.5, text_col: str = "text") -> DataFrame:
    """The documents that score under limit, with all their columns.

    Columns named like one of the scores are set aside while scoring and come back unchanged.
    """
    clash = {c: f"__own_{c}" for c in docs.columns if c in ("strongest", "total", "clauses", "score") and c != text_col}
    scored = score(docs.withColumnsRenamed(clash), model, text_col, keep_text=True)
    return scored.where(F.col("score") < limit).select(*(F.col(clash.get(c, c)).alias(c) for c in docs.columns))
