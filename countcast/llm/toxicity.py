"""Toxicity by a learned lexicon: Levenshtein automata over its trie find misspelled terms, their context tells quotes from abuse."""

import re
from collections.abc import Iterable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from countcast.llm.common import stored

THRESHOLD = 0.3
#: Terms: words, and word starts of ``STEM`` letters, that so many labelled documents have ...
LEAST_DOCUMENTS = 4
#: ... of which at least this share is toxic.
LEAST_TOXIC = 0.8
STEM = 4
LONGEST_TERM = 24
#: The lexicon holds at most so many terms, the most telling ones.
MOST_TERMS = 20_000
#: Bound of the labelled documents that are learnt from; of more, those with the smallest hashes of their ids are.
MOST_LABELLED = 200_000
#: Words before and after a term that its context score looks at.
CONTEXT = 4
WORD = re.compile(r"[^\W\d_]+", re.UNICODE)
PARTS = re.compile(r"([^\W\d_]+)", re.UNICODE)
#: Short terms have so many letters at most.
SHORT = 5
#: A word one edit from a short term is ordinary, and no misspelling, if this share of the clean labelled documents has it.
ORDINARY = 1 / 50_000
#: A digit or sign that stands before a letter, as in ``idi0t``; ``SIGNS`` may replace letters.
SIGNS = "0-9_@$!|*€"
SIGN = re.compile(rf"[{SIGNS}]+(?=[^\W\d_])", re.UNICODE)
SPELLED = re.compile(rf"(?:[^\W\d_]|[{SIGNS}])+", re.UNICODE)
LONGEST_SPELLED = 64
# Marks that open or close a quote, and words that report speech.
QUOTES = '"“”„«»‘’'
REPORTING = frozenset("said says say called calls call wrote writes quote quoted quotes word term dijo dice dit disait sagte sagt".split())


def edits_allowed(term: str) -> int:
    """None for stems and up to three letters, one from four letters, two from nine."""
    return 0 if term.endswith("*") or len(term) < 4 else 1 if len(term) < 9 else 2


#: States of a direction and words of a worker that are remembered; beyond, they are forgotten and found anew.
MOST_STATES, MOST_KNOWN = 60_000, 150_000
#: A place in a state is one number: node, awaited letter and edits.
LETTERS, EDITS = 0x110000, 4


class Automaton:
    """The Levenshtein automata of all terms, read from both ends. Of a match's edits at most half lie in the first half of the term or at
    most half in the second one, so each direction allows only that many in the half that it reads first, where most words leave it."""

    def __init__(self, terms: list[str]):
        self.forward, self.backward = Direction(terms, 1), Direction([t for t in terms if edits_allowed(t)], -1)

    def match(self, word: str) -> tuple[str, int] | None:
        """The nearest term within the edits it allows, and the number of edits; a stem only counts for words that are near no term."""
        found, other = self.forward.match(word), self.backward.match(word[::-1])
        if found and other and not found[0].endswith("*"):
            return min(found, other, key=lambda m: (m[1], m[0]))
        return found or other


class Direction:
    """The automata of all terms read in one direction: their trie, walked with the edits spent at each trie node.

    A state is the set of places that a prefix of the input can reach within the edits allowed, with the fewest edits for each. A place is a
    trie node, or a node behind two swapped letters of which one is still to come. States are found by need and kept, so a word costs one
    look-up per letter, and most words leave the automaton after a few letters. An edit puts in, leaves out or replaces a letter, or swaps two
    neighbours; ``edits_allowed`` says how many a term allows. A stem (``term*``) must match as it is and accepts any end.
    """

    def __init__(self, terms: list[str], step: int):
        self.children: list[dict[str, int]] = [{}]
        self.ends: list[str | None] = [None]
        self.stems: list[str | None] = [None]
        self.allowed = [0]
        for term in sorted(terms):
            node, letters, edits = 0, term.removesuffix("*")[::step], edits_allowed(term)
            # An edit at a letter lies behind it; the letter in the middle, and what is put in there, is free in both directions.
            half = len(letters) // 2 + 1 if step > 0 else len(letters) - len(letters) // 2
            for depth, letter in enumerate(letters):
                self.allowed[node] = max(self.allowed[node], edits // 2 if depth < half else edits)
                if letter not in self.children[node]:
                    self.children[node][letter] = len(self.children)
                    self.children.append({})
                    self.ends.append(None)
                    self.stems.append(None)
                    self.allowed.append(0)
                node = self.children[node][letter]
            self.allowed[node] = max(self.allowed[node], edits)
            if term.endswith("*"):
                self.stems[node] = term
            else:
                self.ends[node] = term
        self._forget()

    def _forget(self) -> None:
        self.states: list[tuple] = []
        self.known: dict[tuple, int] = {}
        self.moves: list[dict[str, int]] = []
        self.found: list[tuple[str, int] | None] = []
        self.start = self._state({0: 0}, None)

    def _state(self, places: dict[int, int], stem: str | None) -> int:
        """Adds what skipped term letters reach, and names the state; -1 if nothing is left. A place is ``node * LETTERS + awaited``."""
        todo = [(place // LETTERS, edits) for place, edits in places.items() if not place % LETTERS]
        while todo:
            node, edits = todo.pop()
            for child in self.children[node].values():
                if edits + 1 <= self.allowed[child] and edits + 1 < places.get(child * LETTERS, 99):
                    places[child * LETTERS] = edits + 1
                    todo.append((child, edits + 1))
        here = [(place // LETTERS, edits) for place, edits in places.items() if not place % LETTERS]
        stem = stem or min((self.stems[n] for n, e in here if e == 0 and self.stems[n]), default=None)
        if not places and stem is None:
            return -1
        key = (stem, *sorted(place * EDITS + edits for place, edits in places.items()))
        if key not in self.known:
            self.known[key] = len(self.states)
            self.states.append(key)
            self.moves.append({})
            ends = [(e, self.ends[n]) for n, e in here if self.ends[n] and e <= edits_allowed(self.ends[n])]
            best = min(ends, default=None)
            # A stem at the start of a word counts as it is, unless the word is a term.
            self.found.append((best[1], best[0]) if best and (best[0] == 0 or not stem) else (stem, 0) if stem else None)
        return self.known[key]

    def _move(self, state: int, letter: str) -> int:
        stem, *packed = self.states[state]
        after: dict[int, int] = {}

        def reach(node: int, awaited: int, edits: int) -> None:
            if edits == 0 or edits <= self.allowed[node]:
                place = node * LETTERS + awaited
                after[place] = min(after.get(place, 99), edits)

        for number in packed:
            place, edits = divmod(number, EDITS)
            node, awaited = divmod(place, LETTERS)
            if awaited:
                if awaited == ord(letter):
                    reach(node, 0, edits)
                continue
            reach(node, 0, edits + 1)  # an extra letter in the word
            for other, child in self.children[node].items():
                reach(child, 0, edits + (other != letter))
                if other != letter and letter in self.children[child]:
                    reach(self.children[child][letter], ord(other), edits + 1)
        self.moves[state][letter] = found = self._state(after, stem)
        return found

    def match(self, word: str) -> tuple[str, int] | None:
        """The nearest term within the edits it allows, and the number of edits."""
        if len(self.states) > MOST_STATES:
            self._forget()
        state = self.start
        for letter in word:
            following = self.moves[state].get(letter)
            state = self._move(state, letter) if following is None else following
            if state < 0:
                return None
        return self.found[state]


def doubtful(match: tuple[str, int]) -> bool:
    """An edit of a short term: many words are that near to one by chance."""
    return match[1] > 0 and len(match[0]) <= SHORT


class Lexicon(dict):
    """Terms with their weights; ``ordinary`` are frequent words of clean documents that the automaton would take for misspellings."""

    ordinary: frozenset = frozenset()


class Matcher:
    """What the automaton finds, but for ordinary words in the place of short terms."""

    def __init__(self, terms: Iterable[str], ordinary: frozenset = frozenset()):
        self.automaton, self.ordinary = Automaton(list(terms)), ordinary

    def match(self, word: str) -> tuple[str, int] | None:
        found = self.automaton.match(word)
        return None if found and doubtful(found) and word in self.ordinary else found

    def spelled_with_signs(self, text: str) -> list[tuple[int, int, str, int]]:
        """Places, term and edits of words with digits or signs in them that are a term's misspelling; trailing signs are punctuation."""
        found, end = [], 0
        for sign in SIGN.finditer(text):
            if sign.start() < end:
                continue
            begin = sign.start()
            while begin > end and sign.start() - begin < LONGEST_SPELLED and SPELLED.fullmatch(text[begin - 1]):
                begin -= 1
            end = SPELLED.match(text, begin).end()
            word = re.sub(rf"[{SIGNS}]+$", "", text[begin:end])
            match = self.match(word) if not WORD.fullmatch(word) else None
            if match and not match[0].endswith("*"):
                found.append((begin, begin + len(word), *match))
        return found


FEATURES = ["any", "hits", "density", "edited", "quoted", "weight", "distinct", "stems"]


def features(text: str | None, matcher: Matcher, weights: dict[str, float], known: dict[str, tuple | None]) -> list[float]:
    """The document's numbers, in the order of ``FEATURES``; all 0 without a match."""
    text = (text or "").lower()
    # Text between words and words take turns.
    parts = PARTS.split(text)
    words = parts[1::2]
    different = set(words)
    for word in different.difference(known):
        known[word] = matcher.match(word)
    found = {w: match for w in different if (match := known[w])}
    for word in different:
        if len(word) > LONGEST_SPELLED:  # long words are read, but not kept
            del known[word]
    signed = matcher.spelled_with_signs(text)
    if signed:
        parts, found_at = _with_signs(parts, signed, found)
    else:
        found_at = [(k, found[w]) for k, w in enumerate(words) if w in found] if found else []
    if not found_at:
        return [0.0] * len(FEATURES)
    n = len(parts) // 2
    hits = edited = quoted = stems = 0.0
    top, terms = 0.0, set()
    for k, (term, edits) in found_at:
        before = parts[2 * max(0, k - CONTEXT) + 1:2 * k + 1]
        after = parts[2 * k + 2:2 * min(n - 1, k + CONTEXT) + 2]
        in_quotes = any(q in p for p in before for q in QUOTES) and any(q in p for p in after for q in QUOTES)
        reported = any(w in REPORTING for w in before[0::2])
        hits += 1
        edited += edits > 0
        stems += term.endswith("*")
        quoted += in_quotes or reported
        top = max(top, weights[term])
        terms.add(term)
    return [1.0, np.log1p(hits), np.log1p(100 * hits / n), edited / hits, quoted / hits, top, np.log1p(len(terms)), stems / hits]


def _with_signs(parts: list[str], signed: list[tuple], found: dict[str, tuple]) -> tuple[list[str], list[tuple]]:
    """The parts with each word of ``signed`` in the place of its pieces, and the matches with their places among the words."""
    merged, matches = [""], []
    at, coming = 0, list(reversed(signed))
    for k, part in enumerate(parts):
        start, at = at, at + len(part)
        while coming and start < at and coming[-1][0] < at:  # a word with signs begins inside this part, or goes on in it
            begin, end, term, edits = coming[-1]
            inside = max(start, begin)
            if start <= begin:
                merged[-1] += part[:begin - start] if len(merged) % 2 else ""
                matches.append((len(merged) // 2, (term, edits)))
                merged += ["", ""]
            merged[-2] += part[inside - start:end - start]
            if end > at:
                start = at
                break
            coming.pop()
            part, start = part[end - start:], end
        if start < at:
            if k % 2 and len(part) == at - start and start == at - len(parts[k]):
                if part in found:
                    matches.append((len(merged) // 2, found[part]))
                merged += [part, ""]
            else:
                merged[-1] += part
    return merged, matches


def fit_logistic(x: np.ndarray, y: np.ndarray, ridge: float = 1e-2, steps: int = 25) -> np.ndarray:
    """Weights (intercept first) by Newton steps with a small ridge."""
    x = np.column_stack([np.ones(len(x)), x])
    w = np.zeros(x.shape[1])
    penalty = ridge * np.eye(len(w)) * max(1, len(x)) / 100
    for _ in range(steps):
        p = 1 / (1 + np.exp(-np.clip(x @ w, -30, 30)))
        step = np.linalg.solve((x * (p * (1 - p))[:, None]).T @ x + penalty, x.T @ (y - p) - penalty @ w)
        w += step
        if np.abs(step).max() < 1e-8:
            break
    return w


def words_of(labelled: DataFrame) -> DataFrame:
    """``toxic, words`` of documents with ``text`` and ``toxic``, stored: the distinct words in lower case, from which all counts are taken."""
    words = F.array_distinct(F.regexp_extract_all(F.lower("text"), F.lit(r"(\p{L}+)"), 1))
    return stored(labelled.select("toxic", words.alias("words")), "toxic-words")


def learn_terms(words: DataFrame) -> Lexicon:
    """The lexicon with weights (log odds of toxic), from ``words_of`` labelled documents; stems end in ``*``.

    Documents are counted per word and per word start, by Spark; only the terms, ``MOST_TERMS`` at most, and the ordinary words reach the driver.
    """
    stems = F.array_distinct(F.transform(F.filter(F.col("words"), lambda w: F.length(w) > STEM), lambda w: F.concat(F.substring(w, 1, STEM), F.lit("*"))))

    def terms(toxic: int) -> DataFrame:
        return words.filter(F.col("toxic") == toxic).select(F.explode(F.concat("words", stems)).alias("term")).filter(F.length("term") <= LONGEST_TERM)

    # Only terms of toxic documents can enter the lexicon; the others are counted for those.
    wanted = stored(terms(1).groupBy("term").agg(F.count("*").alias("toxic")).filter(F.col("toxic") >= LEAST_DOCUMENTS), "toxic-terms")
    clean = terms(0).groupBy("term").agg(F.count("*").alias("clean"))
    found = (
        wanted.join(clean, "term", "left").withColumn("clean", F.coalesce("clean", F.lit(0)))
        .filter((F.col("toxic") >= LEAST_TOXIC * (F.col("toxic") + F.col("clean"))) & (F.length("term") >= 3))
        .orderBy(F.desc(F.col("toxic") / (F.col("toxic") + F.col("clean") + 2)), "term").limit(MOST_TERMS).collect()
    )
    n = words.agg(F.count_if(F.col("toxic") == 1).alias("toxic"), F.count_if(F.col("toxic") == 0).alias("clean")).first()
    lexicon = Lexicon({r["term"]: float(np.log((r["toxic"] + 0.5) / (n["toxic"] + 1)) - np.log((r["clean"] + 0.5) / (n["clean"] + 1))) for r in found})
    lexicon.ordinary = _ordinary(words.filter("toxic = 0"), lexicon, n["clean"])
    return lexicon


def _ordinary(clean: DataFrame, terms: dict[str, float], n_clean: int) -> frozenset:
    """Words that the automaton takes for a misspelling of a short term and that at least the share ``ORDINARY`` of the clean documents has. So many words
    can't be more than a document's distinct words divided by ``ORDINARY``, on average; only they reach the driver."""
    sent = clean.sparkSession.sparkContext.broadcast([t for t in terms if doubtful((t, 1))])

    def near(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        automaton = Automaton(sent.value)
        for batch in batches:
            found = [w for w in batch.column(0).to_pylist() if (m := automaton.match(w)) and m[1]]
            yield pa.RecordBatch.from_arrays([pa.array(found, pa.string())], names=["word"])

    words = (
        clean.select(F.explode("words").alias("word")).filter(F.length("word").between(3, SHORT + 1))
        .groupBy("word").agg(F.count("*").alias("n")).filter(F.col("n") >= ORDINARY * n_clean).select("word")
    )
    return frozenset(r["word"] for r in words.mapInArrow(near, "word string").collect())


_kept: dict[int, tuple] = {}


def _measured(docs: DataFrame, terms: dict[str, float], *keep: str) -> DataFrame:
    sent = docs.sparkSession.sparkContext.broadcast(terms)

    def measure(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        if id(sent.value) not in _kept:
            _kept.clear()
            _kept[id(sent.value)] = (sent.value, Matcher(sent.value, getattr(sent.value, "ordinary", frozenset())), {})
        weights, matcher, known = _kept[id(sent.value)]
        for batch in batches:
            rows = []
            for text in batch.column(batch.num_columns - 1):
                if len(known) > MOST_KNOWN:
                    known.clear()
                rows.append(features(text.as_py(), matcher, weights, known))
            yield pa.RecordBatch.from_arrays(
                [batch.column(k) for k in range(batch.num_columns - 1)] + [pa.array(rows, pa.list_(pa.float64()))], names=[*keep, "features"])

    types = dict(docs.dtypes)
    return docs.select(*keep, "text").mapInArrow(measure, ", ".join(f"`{c}` {types[c]}" for c in keep) + ", features array<double>")


def fit_weights(measured: DataFrame) -> np.ndarray:
    """Weights from ``toxic, features`` of labelled documents. Without any toxic or any clean document they give the share of toxic ones."""
    rows = measured.groupBy("toxic", "features").count().collect()
    x = np.array([r["features"] for r in rows], dtype=float).reshape(-1, len(FEATURES))
    y = np.array([r["toxic"] for r in rows], dtype=float)
    times = np.array([r["count"] for r in rows], dtype=int)
    return fit_logistic(np.repeat(x, times, axis=0), np.repeat(y, times))


def fit(labelled: DataFrame) -> tuple[Lexicon, np.ndarray]:
    """Lexicon and weights from documents with ``text`` and ``toxic``; rows with other labels than 0 and 1, and NULL texts, are left out."""
    labelled = labelled.select("text", F.col("toxic").cast("int").alias("toxic")).filter("text is not null and toxic in (0, 1)")
    terms = learn_terms(words_of(labelled))
    return terms, fit_weights(_measured(labelled, terms, "toxic"))


def score(docs: DataFrame, terms: dict[str, float], weights: np.ndarray, *keep: str) -> DataFrame:
    """The columns ``keep`` of every document and its ``score`` (0 to 1); NULL and empty texts score as texts without a term."""
    return with_score(_measured(docs, terms, *keep), weights).select(*keep, "score")


def with_score(measured: DataFrame, weights: np.ndarray) -> DataFrame:
    margin = F.lit(float(weights[0]))
    for k in range(len(FEATURES)):
        margin = margin + F.lit(float(weights[k + 1])) * F.col("features")[k]
    return measured.withColumn("score", 1 / (1 + F.exp(-margin)))


def flags(labels: DataFrame) -> DataFrame:
    """``label_id, toxic`` of labelled documents, ``MOST_LABELLED`` at most; one with several labels counts as toxic if one says so.

    That bound makes the table small enough to be sent to all tasks, so no text is shuffled to find its label.
    """
    one = labels.filter("doc_id is not null and toxic in (0, 1)").groupBy(F.col("doc_id").alias("label_id")).agg(F.max("toxic").cast("int").alias("toxic"))
    return F.broadcast(stored(one.orderBy(F.xxhash64("label_id"), "label_id").limit(MOST_LABELLED), "toxic-flags"))


def labelled_documents(docs: DataFrame, labels: DataFrame) -> DataFrame:
    """``doc_id, text, toxic`` of documents with a toxic label (see ``flags``)."""
    return docs.select("doc_id", "text").join(flags(labels), F.col("doc_id") == F.col("label_id")).select("doc_id", "text", "toxic")


def score_documents(docs: DataFrame, labels: DataFrame, learn_from=None) -> DataFrame:
    """``doc_id, score`` of every row of ``docs``, by terms and weights learnt from its labelled rows that meet the condition ``learn_from``.

    Each text is measured once: the weights are fitted on stored numbers. Rows without id are scored, but have no label.
    """
    known = labelled_documents(docs if learn_from is None else docs.filter(learn_from), labels).filter("text is not null")
    terms = learn_terms(words_of(known))
    measured = stored(_measured(docs, terms, "doc_id"), "toxic-measured")
    learnt = (measured if learn_from is None else measured.filter(learn_from)).join(flags(labels), F.col("doc_id") == F.col("label_id"))
    return with_score(measured, fit_weights(learnt)).select("doc_id", "score")
