"""Toxicity: a learned lexicon, matched by Levenshtein automata over its trie, judged in context.

Learning. A bounded sample of labelled documents (SAMPLE_ROWS, the smallest by a hash of the id)
gives document counts of every word. Words and word stems that toxic documents use far more
often than clean ones become the lexicon, each weighted by its smoothed log-odds.

Matching. The lexicon is a trie; its product with the Levenshtein automata of its terms
(no edit for terms under five letters, one for medium, two for long ones; a letter more, less or
other, and neighbours that changed places, are one edit each) is made deterministic state by state as words
ask for it. A word that leaves every live path is dropped after a few letters, so each
distinct word a task meets costs little, and repeats cost a lookup. Misspelled forms weigh
less; a form that clean sample documents use is an ordinary word and never matches.

Judging. Every hit is weighed by its context window: quotation marks that open before and close
after it, reporting words and address in the second person. Quoted, reported terms weigh little, abuse in full.
The score is the logistic of the base rate's log-odds plus the hits' weights; a text without any hit
gets the sample's rate for such texts.
"""

from __future__ import annotations

import math
import re
from collections import Counter
from collections.abc import Iterator
from dataclasses import dataclass, field

import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ledgerforge.llm.tasks import CACHE_WORDS
from ledgerforge.sources.staging import Staging

SAMPLE_ROWS = 20_000
LEAST_DOCUMENTS = 10  # toxic sample documents that must use a term
LEAST_WEIGHT = 2.0  # of a term's log-odds, two standard errors below the estimate
STEM_LETTERS = 4  # a stem has at least so many
STEM_WORDS = 5  # and is followed by at least so many endings, none with most of the uses
THRESHOLD = 0.3
WINDOW = 6  # tokens on either side of a hit
EDIT_COST = (0.0, 4.0, 6.0)  # taken from a term's weight, by edits: weak terms must be exact

# Quotation marks, reporting words and forms of address in the four languages.
OPENING, CLOSING = "\"'«“„‘‹", "\"'»”“’›"
REPORTING = frozenset(
    "said says called calls wrote quoted quote word term insult sagte nannte schrieb wort dit appelé écrit mot dijo llamó palabra".split()
)
ADDRESS = frozenset("you your you're u ur du dich dir ihr tu te toi vous tú usted eres".split())
EDGES = re.compile(r"^[\W_]+|[\W_]+$")
PARTS = re.compile(r"[\W_]+")


def allowed_edits(term: str) -> int:
    return 0 if len(term) < 5 else 1 if len(term) < 9 else 2


class LexiconAutomaton:
    """Finds the best term for a word: exact, within its allowed edits, or as a stem of the word."""

    def __init__(self, words: list[str], stems: list[str]):
        self.children: list[dict[str, int]] = [{}]
        self.terminal: list[tuple[str, int, bool] | None] = [None]
        self.budget = [0]  # most edits any term below may take
        for term, stem in [(w, False) for w in words] + [(s, True) for s in stems]:
            edits = max(0, allowed_edits(term) - 1) if stem else allowed_edits(term)  # endings are free already
            node = 0
            for letter in term:
                self.budget[node] = max(self.budget[node], edits)
                if letter not in self.children[node]:
                    self.children[node][letter] = len(self.children)
                    self.children.append({})
                    self.terminal.append(None)
                    self.budget.append(0)
                node = self.children[node][letter]
            self.budget[node] = max(self.budget[node], edits)
            self.terminal[node] = (term, edits, stem)
        self._forget()

    def _forget(self) -> None:
        self.moves: dict[tuple[int, str], int] = {}
        self.ids: dict[frozenset, int] = {}
        self.states: list[frozenset] = []
        self.word_end: list[tuple[int, str] | None] = []
        self.stem_end: list[tuple[int, str] | None] = []
        self.start = self._state({(0, 0, "")})

    def _state(self, live: set[tuple[int, int, str]]) -> int:
        """The state of all live (trie node, edits, letter still to come of a swapped pair), closed under
        letters missing from the word."""
        pending, best = list(live), {}
        while pending:
            node, edits, swapped = pending.pop()
            if edits > self.budget[node] or edits >= best.get((node, swapped), 99):
                continue
            best[node, swapped] = edits
            if not swapped:
                pending += [(child, edits + 1, "") for child in self.children[node].values()]
        key = frozenset((node, edits, swapped) for (node, swapped), edits in best.items())
        if key not in self.ids:
            self.ids[key] = len(self.states)
            self.states.append(key)
            ends = [(e, *self.terminal[n]) for n, e, swapped in key if self.terminal[n] and not swapped]
            self.word_end.append(min(((e, t) for e, t, most, _ in ends if e <= most), default=None))
            self.stem_end.append(min(((e, t) for e, t, most, stem in ends if stem and e <= most), default=None))
        return self.ids[key]

    def _move(self, state: int, letter: str) -> int:
        live = set()
        for node, edits, swapped in self.states[state]:
            if swapped:
                if swapped == letter:
                    live.add((node, edits, ""))
                continue
            live.add((node, edits + 1, ""))  # a letter too many
            for other, child in self.children[node].items():
                live.add((child, edits + (other != letter), ""))
                if other != letter and letter in self.children[child]:  # neighbours that changed places
                    live.add((self.children[child][letter], edits + 1, other))
        self.moves[state, letter] = to = self._state(live)
        return to

    def match(self, word: str) -> tuple[int, str] | None:
        """(edits, term) or None."""
        if len(self.moves) > CACHE_WORDS:
            self._forget()
        state, best, moves = self.start, None, self.moves
        for letter in word:
            to = moves.get((state, letter))
            state = self._move(state, letter) if to is None else to
            if not self.states[state]:
                return best
            stem = self.stem_end[state]
            if stem and (best is None or stem < best):
                best = stem
        end = self.word_end[state]
        return min((x for x in (best, end) if x), default=None)


@dataclass
class ToxicityModel:
    weights: dict[str, float]  # words, and stems ending in "*"
    base_rate: float
    quiet_rate: float  # of texts without a hit
    ordinary: frozenset[str] = field(default_factory=frozenset)

    def automaton(self) -> LexiconAutomaton:
        return LexiconAutomaton(
            [t for t in self.weights if not t.endswith("*")], [t[:-1] for t in self.weights if t.endswith("*")]
        )


class _Judge(dict):
    """token -> weight of the term it spells, or None; scores texts."""

    def __init__(self, model: ToxicityModel):
        self.model, self.automaton = model, model.automaton()
        self.base = math.log(model.base_rate / (1 - model.base_rate))

    def __missing__(self, token: str) -> float | None:
        word = EDGES.sub("", token)
        forms = {word, *PARTS.split(word)} - {""}
        best = None
        for form in forms:
            found = self.automaton.match(form)
            if found and not (found[0] and form in self.model.ordinary):
                edits, term = found
                weight = self.model.weights.get(term) or self.model.weights[term + "*"]
                if weight > EDIT_COST[edits]:
                    best = max(best or 0.0, weight - EDIT_COST[edits])
        self[token] = best
        return best

    def score(self, text: str) -> float:
        if len(self) > CACHE_WORDS:
            self.clear()
        tokens = text.lower().split()
        weights = list(map(self.__getitem__, tokens))
        total = 0.0
        for at, weight in enumerate(weights):
            if weight is not None:
                total += weight * context_share(tokens, at)
        if not total:
            return self.model.quiet_rate
        return 1 / (1 + math.exp(-self.base - total))


def _quotation(tokens: list[str], at: int) -> tuple[int, int] | None:
    """First and last token of the marks around a hit, if they open before and close after it."""
    low, high = max(0, at - WINDOW), min(len(tokens), at + 1 + WINDOW)
    opened = next((i for i in range(at, low - 1, -1) if tokens[i][0] in OPENING), None)
    ends = (i for i in range(at, high) if len(tokens[i]) > 1 or tokens[i] not in OPENING)
    closed = next((i for i in ends if (mark := tokens[i].rstrip(".,;:!?")[-1:]) and mark in CLOSING), None)
    return None if opened is None or closed is None else (opened, closed)


def context_share(tokens: list[str], at: int) -> float:
    """How much of a hit counts: 1 for plain use, little inside a reported quotation or as the subject of a remark.

    Inside a quotation, whom it addresses plays no part: only address outside of the marks counts. Two reporting
    words without any address are a remark about the term.
    """
    low, high = max(0, at - WINDOW), min(len(tokens), at + 1 + WINDOW)
    quoted = _quotation(tokens, at)
    around = {EDGES.sub("", tokens[i]) for i in range(low, high) if i != at}
    inside = range(quoted[0], quoted[1] + 1) if quoted else range(0)
    outside = {EDGES.sub("", tokens[i]) for i in range(low, high) if i != at and i not in inside}
    reporting, addressed = len(around & REPORTING), bool(outside & ADDRESS)
    share = 1.0 - 0.7 * bool(quoted) - 0.25 * bool(reporting) + 0.3 * addressed
    if reporting > 1 and not addressed:
        share -= 0.7
    return min(1.0, max(0.05, share))


def _document_words(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Documents (text, toxic) -> term, clean documents that use it, or the place of one toxic use.

    A place is a hash of a word and its neighbours, the smallest in the document, so that a
    document counts once, and copies of a toxic document are one piece of evidence and not
    many. Toxic documents report their stems as well.
    """
    clean, toxic = Counter(), []

    def emptied() -> pa.RecordBatch:
        columns = [
            pa.array([*clean, *(term for term, _, _ in toxic)], pa.string()),
            pa.array([*(False for _ in clean), *(stem for _, stem, _ in toxic)], pa.bool_()),
            pa.array([*clean.values(), *(0 for _ in toxic)], pa.int64()),
            pa.array([*(None for _ in clean), *(place for _, _, place in toxic)], pa.int64()),
        ]
        clean.clear()
        toxic.clear()
        return pa.record_batch(columns, names=["term", "stem", "clean", "place"])

    for batch in batches:
        for text, label in zip(batch.column(0), batch.column(1).to_pylist()):
            words = [EDGES.sub("", token) for token in (text.as_py() or "").lower().split()]
            if not label:
                clean.update(set(words) - {""})
            else:
                places: dict[tuple[str, bool], int] = {}
                for before, word, after in zip(["", *words], words, [*words[1:], ""]):
                    place = xxhash.xxh64_intdigest(f"{before} {word} {after}") >> 1
                    for term in [(word, False), *((word[:n], True) for n in range(STEM_LETTERS, len(word) + 1))]:
                        places[term] = min(place, places.get(term, place))
                toxic.extend((term, stem, place) for (term, stem), place in places.items() if term)
            if len(clean) + len(toxic) > CACHE_WORDS:
                yield emptied()
    yield emptied()


def labelled_sample(docs: DataFrame, labels: DataFrame, rows: int, *, doc_id="doc_id", text="text") -> DataFrame:
    """(text, toxic) of at most `rows` labelled ids; a document labelled twice is toxic if either says so."""
    picked = (
        labels.filter(F.col("toxic").isin(0, 1) & F.col(doc_id).isNotNull())
        .groupBy(F.col(doc_id).alias("labelled"))
        .agg(F.max("toxic").cast("int").alias("toxic"))
        .orderBy(F.xxhash64("labelled"), "labelled")
        .limit(rows)
    )
    return docs.select(F.col(doc_id).alias("labelled"), F.col(text).alias("text")).join(F.broadcast(picked), "labelled").select(
        "text", "toxic"
    )


def _choose_terms(candidates: list) -> dict[str, float]:
    """Words, and stems where several endings share the evidence; a stem replaces its words."""
    stems = {r.term: r for r in candidates if r.stem}
    fullest = Counter()
    for term, row in stems.items():
        fullest[term[:-1]] = max(fullest[term[:-1]], row.toxic)
    chosen: dict[str, float] = {}
    for term in sorted(stems, key=len):
        covered = any(term[:n] + "*" in chosen for n in range(STEM_LETTERS, len(term)))
        if not covered and fullest[term] < 0.95 * stems[term].toxic:
            chosen[term + "*"] = stems[term].weight
    for row in candidates:
        if not row.stem and not any(row.term[:n] + "*" in chosen for n in range(STEM_LETTERS, len(row.term) + 1)):
            chosen[row.term] = row.weight
    return dict(sorted(chosen.items(), key=lambda item: (-item[1], item[0])))


def train(
    docs: DataFrame, labels: DataFrame, *, sample_rows=SAMPLE_ROWS, doc_id="doc_id", text="text"
) -> ToxicityModel:
    """Learn from `labels` (doc_id, toxic 0/1); rows with other or null labels are left out.

    What reaches the driver is bounded by the sample: terms that at least LEAST_DOCUMENTS of its toxic
    documents use, the sample's words close to them, and two sums. Without toxic examples the lexicon is empty.
    """
    staging = Staging(docs.sparkSession, "toxicity")
    sample = staging.keep(labelled_sample(docs, labels, sample_rows, doc_id=doc_id, text=text), "sample")
    sizes = {r.toxic: r.n for r in sample.groupBy("toxic").agg(F.count("*").alias("n")).collect()}
    clean, toxic = sizes.get(0, 0), sizes.get(1, 0)
    base = (toxic + 1) / (clean + toxic + 20)
    terms = (
        sample.mapInArrow(_document_words, "term string, stem boolean, clean bigint, place bigint")
        .groupBy("term", "stem")
        .agg(F.sum("clean").alias("clean"), F.count_distinct("place").alias("toxic"))
    )
    terms = staging.keep(terms, "terms")
    words = terms.filter("not stem").drop("stem")
    weight = F.log((F.col("toxic") + 0.5) / (toxic + 1.0)) - F.log((F.col("clean") + 0.5) / (clean + 1.0))
    # Clean uses of a stem are summed over its words: too many rather than too few.
    lengths = F.sequence(F.lit(STEM_LETTERS), F.greatest(F.lit(STEM_LETTERS), F.char_length("term")))
    endings = (
        words.withColumn("term", F.explode(F.transform(lengths, lambda n: F.substring("term", F.lit(1), n))))
        .groupBy("term")
        .agg(F.sum("clean").alias("clean"), F.count("*").alias("endings"), F.max("toxic").alias("largest"))
        .filter(F.col("endings") >= STEM_WORDS)
    )
    stems = (
        terms.filter("stem").select("term", "toxic").join(endings, "term").filter(2 * F.col("largest") <= F.col("toxic"))
    )

    def strongest(terms: DataFrame, stem: bool) -> list:
        error = F.sqrt(1 / (F.col("toxic") + 0.5) + 1 / (F.col("clean") + 0.5))
        surely = weight - 2 * error >= LEAST_WEIGHT
        strong = terms.filter((F.col("toxic") >= LEAST_DOCUMENTS) & surely).select(
            "term", "toxic", F.lit(stem).alias("stem"), weight.alias("weight")
        )
        return strong.orderBy(F.desc("weight"), "term").collect()

    weights = _choose_terms(strongest(words, False) + strongest(stems, True))
    model = ToxicityModel(weights, base, base)
    automaton = model.automaton()

    @F.arrow_udf(T.BooleanType())
    def misspelled(column: pa.Array) -> pa.Array:
        found = (automaton.match(word) for word in column.to_pylist())
        return pa.array([bool(hit and hit[0]) for hit in found], pa.bool_())

    ordinary = words.filter("clean > 0").filter(misspelled("term")).select("term").collect()
    model.ordinary = frozenset(r.term for r in ordinary)
    hits = sample.select("toxic", toxicity(F.col("text"), model).alias("score"))
    quiet = hits.filter(F.col("score") == base).agg(F.sum("toxic"), F.count("*")).first()
    model.quiet_rate = ((quiet[0] or 0) + 0.5) / (quiet[1] + 20)
    return model


def toxicity(text: Column, model: ToxicityModel) -> Column:
    """Score from 0 to 1 of a text, higher for toxic ones; null and empty texts score as texts without a hit."""

    @F.arrow_udf(T.DoubleType())
    def scores(batches: Iterator[pa.Array]) -> Iterator[pa.Array]:
        judge = _Judge(model)
        for texts in batches:
            yield pa.array([judge.score(text.as_py() or "") for text in texts], pa.float64())

    return scores(text)


def without_toxic(
    docs: DataFrame, model: ToxicityModel, *, text="text", threshold=THRESHOLD
) -> DataFrame:
    """`docs` without the rows that score `threshold` or more; columns and repeats stay."""
    return docs.filter(toxicity(F.col(text), model) < threshold)
