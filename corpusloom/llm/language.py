"""Problem 9: a language and a confidence for every document and paragraph.

Method: hierarchical discrimination. Linear support vector machines first tell
language families apart, then one-versus-one machines tell the closely related
languages of the family apart. The machines have no intercept and their
features are counted a word, so the decision for a text is the sign of the sum
of its words' scores: each distinct word is scored once, and a text of any
length costs one addition a word.
"""

from __future__ import annotations

import re
import unicodedata
from collections import Counter
from collections.abc import Iterator
from itertools import combinations

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from ..functions.keys import label_key
from ..runtime import bounded_side

#: Family of each language; a language not listed is a family of its own.
FAMILIES = {"pt": "ibero", "gl": "ibero", "es": "ibero", "fr": "gallo-italic", "it": "gallo-italic", "en": "germanic", "de": "germanic"}
#: Labelled samples used for each language, at most (the bounded sample the machines are fitted on).
SAMPLES_A_LANGUAGE = 1000
#: Words from which a paragraph is judged by itself.
LEAST_WORDS = 5
#: Most labels of an alias table, which is broadcast.
LABEL_ROWS = 100_000
#: Scored words that a worker keeps.
KEPT_WORDS = 400_000

_PARTING = re.compile(r"\n(?:[^\S\n]*\n)+")
_BROKEN = re.compile("[ÂÃ][\u0080-ÿŒ-Ÿƒˆ˜–-›€™]")


def paragraphs(text: str) -> list[str]:
    """Pieces of a text parted by lines of white space only; blank pieces do not count."""
    if "\n" not in text:
        return [text] if text.strip() else []
    return [p for p in _PARTING.split(f"\n\n{text}\n\n") if p.strip()]


def _mend(word: str) -> str:
    """Undoes UTF-8 that was read as a one-byte code, where it can be undone."""

    def back(m: re.Match) -> str:
        try:
            first, second = m.group().encode("latin-1" if m.group()[1] < "Ā" else "cp1252")
            return bytes((first, second)).decode("utf-8")
        except UnicodeError:
            return m.group()

    return _BROKEN.sub(back, word)


def word_features(word: str) -> list[str]:
    """Features of one word: the whole word and its runs of 2 to 4 characters, without accents; with accents too where it has some."""
    word = "".join(c for c in unicodedata.normalize("NFC", _mend(word)).casefold() if c.isalpha() or c in "'’-").strip("'’-")
    if not word:
        return []
    out = []
    plain = word if word.isascii() else "".join(c for c in unicodedata.normalize("NFD", word) if not unicodedata.combining(c))
    edged = f"<{plain}>"
    out.append(f"={plain}")
    for n in (2, 3, 4):
        out += [edged[i : i + n] for i in range(len(edged) - n + 1)]
    if plain != word:
        edged = f"<{word}>"
        out += [x for n in (1, 2, 3) for i in range(len(edged) - n + 1) if not (x := edged[i : i + n]).isascii()]
    return out


def has_letter(piece: str) -> bool:
    """Whether a white-space separated piece is a word."""
    return piece.isalpha() or any(map(str.isalpha, piece))


def _views(text: str) -> Iterator[list[str]]:
    """What a sample teaches: itself, itself without accents, and its stretches of six words."""
    words = [w for w in text.split() if has_letter(w)]
    bare = [w for w in "".join(c for c in unicodedata.normalize("NFD", text) if not unicodedata.combining(c)).split() if has_letter(w)]
    for view in (words, bare):
        yield view
        if len(view) > 8:
            yield from (view[i : i + 6] for i in range(0, len(view) - 2, 6))


class Discriminator:
    """The machines: a matrix of one row a feature and one column a machine."""

    def __init__(self, languages: list[str], families: dict[str, str]) -> None:
        self.languages = sorted(languages)
        self.family = {x: families.get(x, x) for x in self.languages}
        self.groups = sorted(set(self.family.values()))
        # machines: (level, first, second); a positive score speaks for the first
        self.machines = [("family", a, b) for a, b in combinations(self.groups, 2)]
        for g in self.groups:
            inside = [x for x in self.languages if self.family[x] == g]
            self.machines += [(g, a, b) for a, b in combinations(inside, 2)]
        self.features: dict[str, int] = {}
        self.slope = 4.0
        self.weights = np.zeros((1, len(self.machines)), dtype=np.float32)

    def side(self, language: str) -> np.ndarray:
        """+1, -1 or 0 (not concerned) for each machine."""
        out = np.zeros(len(self.machines))
        for k, (level, a, b) in enumerate(self.machines):
            own = self.family[language] if level == "family" else language
            out[k] = 1 if own == a else -1 if own == b else 0
        return out

    def fit(self, samples: list[tuple[str, str]], cost: float = 1.0, rounds: int = 12, seed: int = 7) -> Discriminator:
        """Dual coordinate descent for the squared hinge loss, all machines in one pass over the samples."""
        counted = [(self.side(lang), Counter(f for w in view for f in word_features(w))) for lang, text in samples if lang in self.family for view in _views(text) if view]
        seen = Counter(f for _, c in counted for f in c)
        self.features = {f: i for i, f in enumerate(sorted(f for f, n in seen.items() if n > 1))}
        rows = []
        for side, counts in counted:
            known = [(self.features[f], n) for f, n in sorted(counts.items()) if f in self.features]
            if known:
                at = np.array([i for i, _ in known])
                values = np.array([n for _, n in known], dtype=np.float64)
                rows.append((at, values / np.linalg.norm(values), side))
        w = np.zeros((max(1, len(self.features)), len(self.machines)))
        alpha = np.zeros((len(rows), len(self.machines)))
        slack = 1 / (2 * cost)
        order = np.random.default_rng(seed)
        for _ in range(rounds):
            for i in order.permutation(len(rows)):
                at, x, side = rows[i]
                gradient = side * (x @ w[at]) - 1 + slack * alpha[i]
                new = np.where(side != 0, np.maximum(alpha[i] - gradient / (1 + slack), 0), 0)
                step = (new - alpha[i]) * side
                alpha[i] = new
                w[at] += x[:, None] * step
        self.weights = w.astype(np.float32)
        return self

    def score_words(self, words: list[str]) -> np.ndarray:
        """A row for each word: the machines' scores, and the squared length of its features."""
        at, starts = [], []
        for word in words:
            starts.append(len(at))
            at += [i for f in word_features(word) if (i := self.features.get(f)) is not None]
        out = np.zeros((len(words), len(self.machines) + 1), dtype=np.float64)
        if at:
            ends = np.append(starts[1:], len(at))
            full = np.array(starts) < ends
            sums = np.add.reduceat(self.weights[np.array(at)].astype(np.float64), np.array(starts)[full], axis=0)
            out[full, :-1] = sums
            out[full, -1] = (ends - starts)[full]
        return out

    def decide(self, scores: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Index of the language and confidence for each row of summed scores.

        The family with most won duels, then the language with most won duels
        in it; equal numbers go by the sum of margins, then by name. The
        confidence is that of the closest duel the winner fought, from 0.5
        (undecided) to 1; rows without any known feature get 0.
        """
        language, closest = self.margins(scores)
        confidence = 1 / (1 + np.exp(-self.slope * closest))
        return language, np.where(scores[:, -1] > 0, confidence, 0.0)

    def margins(self, scores: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Index of the language, and the margin of the closest duel it fought, for each row of summed scores."""
        n = len(scores)
        margin = scores[:, :-1] / np.sqrt(np.maximum(scores[:, -1:], 1))
        language = np.zeros(n, dtype=np.int64)
        closest = np.full(n, np.inf)
        family = self._duel("family", self.groups, margin, closest, np.ones(n, dtype=bool))
        for k, g in enumerate(self.groups):
            here = family == k
            inside = [x for x in self.languages if self.family[x] == g]
            won = self._duel(g, inside, margin, closest, here)
            language[here] = np.array([self.languages.index(x) for x in inside])[won[here]]
        return language, np.where(np.isfinite(closest), closest, 0.0)

    def calibrate(self, held: list[tuple[str, str]]) -> float:
        """The slope that makes confidences of held-out samples, whole and in stretches of six words, agree best with how often they are right (least log loss)."""
        views = [(lang, view) for lang, text in held if lang in self.family for view in _views(text) if view]
        if not views:
            return self.slope
        at: dict[str, int] = {}
        for _, view in views:
            for w in view:
                at.setdefault(w, len(at))
        table = self.score_words(list(at))
        language, closest = self.margins(np.array([table[[at[w] for w in view]].sum(axis=0) for _, view in views]))
        right = np.array([self.languages[k] == lang for k, (lang, _) in zip(language, views, strict=True)])
        signed = np.where(right, closest, -closest)
        slopes = np.linspace(0.5, 40, 80)
        self.slope = float(slopes[np.argmin([np.logaddexp(0, -k * signed).mean() for k in slopes])])
        return self.slope

    def _duel(self, level: str, names: list[str], margin: np.ndarray, closest: np.ndarray, here: np.ndarray) -> np.ndarray:
        won = np.zeros((len(margin), len(names)))
        least = np.full((len(margin), len(names)), np.inf)
        for k, (lv, a, b) in enumerate(self.machines):
            if lv == level:
                i, j = names.index(a), names.index(b)
                m = margin[:, k]
                won[:, i] += (m >= 0) + 1e-4 * np.tanh(m)
                won[:, j] += (m < 0) - 1e-4 * np.tanh(m)
                least[:, i] = np.minimum(least[:, i], m)
                least[:, j] = np.minimum(least[:, j], -m)
        best = won.argmax(axis=1)
        own = np.take_along_axis(least, best[:, None], axis=1)[:, 0]
        closest[here] = np.minimum(closest[here], own[here])
        return best


def fit_discriminator(samples: DataFrame, families: dict[str, str] | None = None, most: int = SAMPLES_A_LANGUAGE) -> Discriminator:
    """Fits the machines on ``samples(sample_id, lang, text)``, at most ``most`` of each language in the order of a hash of the text.

    Confidences are fitted first: machines of one half of the samples judge the
    other half. The machines themselves know all samples.
    """
    rows = samples.where(F.col("text").isNotNull() & F.col("lang").isNotNull()).select(label_key("lang").alias("lang"), "text", F.sha2("text", 256).alias("h"))
    rows = rows.withColumn("n", F.row_number().over(Window.partitionBy("lang").orderBy("h"))).where(F.col("n") <= most)
    known = [(r.lang, r.text) for r in rows.select("lang", "text", "h").orderBy("lang", "h").collect()]
    languages, families = sorted({lang for lang, _ in known}), FAMILIES if families is None else families
    machine = Discriminator(languages, families).fit(known)
    machine.slope = Discriminator(languages, families).fit(known[::2]).calibrate(known[1::2])
    return machine


def _judge(model, carried: list[str]):
    """Batches of documents to batches of rows, one for the document and one for each paragraph."""

    def judge(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        machine: Discriminator = model.value
        at: dict[str, int] = {}
        table = np.zeros((0, len(machine.machines) + 1))
        for batch in batches:
            if len(at) > KEPT_WORDS:
                at, table = {}, np.zeros((0, len(machine.machines) + 1))
            fresh: list[str] = []
            flat: list[int] = []  # word numbers of all paragraphs, one after another
            starts, owner = [], []  # of each paragraph: where its words start, its document
            for d, text in enumerate(batch["text"]):
                for p in paragraphs(text) if isinstance(text, str) else ():
                    starts.append(len(flat))
                    owner.append(d)
                    for piece in p.split():
                        k = at.get(piece)
                        if k is None:
                            if has_letter(piece):
                                k = at[piece] = len(table) + len(fresh)
                                fresh.append(piece)
                            else:
                                k = at[piece] = -1
                        if k >= 0:
                            flat.append(k)
            if fresh:
                table = np.concatenate([table, machine.score_words(fresh)])
            yield _rows(machine, batch, carried, table, np.array(flat, dtype=np.int64), np.array(starts, dtype=np.int64), np.array(owner, dtype=np.int64))

    return judge


def _rows(machine, batch, carried, table, flat, starts, owner) -> pd.DataFrame:
    docs = len(batch)
    ends = np.append(starts[1:], len(flat)) if len(starts) else starts
    words = ends - starts
    sums = np.zeros((len(starts), table.shape[1]))
    full = words > 0
    if full.any():
        # in pieces, so that no more than a few million word scores exist at once
        heads, step = np.flatnonzero(full), 200_000
        cut_at = 0
        while cut_at < len(heads):
            last = max(cut_at + 1, int(np.searchsorted(ends[heads], starts[heads[cut_at]] + step, side="right")))
            part = heads[cut_at:last]
            base = starts[part[0]]
            sums[part] = np.add.reduceat(table[flat[base : ends[part[-1]]]], starts[part] - base, axis=0)
            cut_at = last
    whole = np.zeros((docs, table.shape[1]))
    np.add.at(whole, owner, sums)
    doc_lang, doc_conf = machine.decide(whole)
    lang, conf = machine.decide(sums) if len(starts) else (np.zeros(0, dtype=np.int64), np.zeros(0))
    short = words < LEAST_WORDS
    lang = np.where(short, doc_lang[owner], lang) if len(starts) else lang
    conf = np.where(short, np.minimum(conf, doc_conf[owner]), conf) if len(starts) else conf
    votes = np.zeros((docs, len(machine.languages)))
    np.add.at(votes, (owner, lang), words)
    total = votes.sum(axis=1)
    # equal numbers of words: the language of the document's summed scores decides
    main = (votes + 0.5 * np.eye(len(machine.languages))[doc_lang]).argmax(axis=1)
    share = votes[np.arange(docs), main] / np.maximum(total, 1)
    number = np.zeros(len(owner), dtype=np.int64)
    if len(owner):
        first = np.searchsorted(owner, owner)
        number = np.arange(len(owner)) - first + 1
    at = np.concatenate([np.arange(docs), owner])
    para = np.concatenate([np.zeros(docs, dtype=np.int64), number])
    order = np.lexsort((para, at))
    names = np.array([*machine.languages, None], dtype=object)
    pick = np.concatenate([np.where(total > 0, main, -1), np.where(words > 0, lang, -1)])
    out = {c: batch[c].to_numpy()[at[order]] for c in carried}
    out["para_no"] = para[order]
    out["lang"] = names[pick][order]
    out["confidence"] = np.concatenate([np.where(total > 0, doc_conf * share, 0.0), np.where(words > 0, conf, 0.0)])[order]
    out["words"] = np.concatenate([total.astype(np.int64), words])[order]
    out["main_lang"] = names[np.where(total > 0, main, -1)][at[order]]
    return pd.DataFrame(out)


def identify(documents: DataFrame, model: Discriminator, carry: tuple[str, ...] = ()) -> DataFrame:
    """A row for each document (para_no 0) and each of its paragraphs (from 1).

    Result: ``doc_id``, the columns of ``carry`` (of simple types), ``para_no``, ``lang``,
    ``confidence`` (0 to 1), ``words``, ``main_lang``. A paragraph's language is
    that of its summed word scores; one of fewer than ``LEAST_WORDS`` words has
    the language of the document's sum. The document's main language is that of
    most words, each paragraph counted whole. Texts are read whole, in one pass
    without a shuffle.

    * NULL, empty or blank text, or one without letters: para_no 0 with lang NULL and confidence 0.
    * Paragraphs without a word: lang NULL, confidence 0. Repeated rows: judged one by one.
    * Empty input: empty result. Columns other than doc_id, text and ``carry`` are ignored.
    """
    spark = documents.sparkSession
    kinds = dict(documents.dtypes)
    carried = ["doc_id", *carry]
    # carried values travel as strings: pandas would turn whole numbers with NULLs among them into floats
    schema = ", ".join(f"`{c}` string" for c in carried) + ", para_no int, lang string, confidence double, words long, main_lang string"
    rows = documents.select(*[F.col(c).cast("string").alias(c) for c in carried], "text")
    return rows.mapInPandas(_judge(spark.sparkContext.broadcast(model), carried), schema).withColumns({c: F.col(c).cast(kinds[c]) for c in carried})


def labelled(documents: DataFrame, aliases: DataFrame) -> DataFrame:
    """``documents`` with ``label_lang``: the language its label stands for, NULL if it is missing or means nothing."""
    known = aliases.select(label_key("alias").alias("__label"), F.col("lang").alias("label_lang")).where(F.col("__label") != "").groupBy("__label").agg(F.min("label_lang").alias("label_lang"))
    rows = documents.select("doc_id", "text", label_key("lang").alias("__label"))
    return rows.join(bounded_side(known, LABEL_ROWS, "a table of labels"), "__label", "left").drop("__label")


def _read(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def p9_languages(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Language and confidence of every document and paragraph."""
    return identify(_read(spark, sf_dir, "documents"), fit_discriminator(_read(spark, sf_dir, "lang_sample")))


def p9_found(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Documents whose label is missing or wrong, and paragraphs in another language than the document's main one."""
    rows = labelled(_read(spark, sf_dir, "documents"), _read(spark, sf_dir, "lang_alias"))
    judged = identify(rows, fit_discriminator(_read(spark, sf_dir, "lang_sample")), ("label_lang",))
    whole = (F.col("para_no") == 0) & (F.col("words") >= LEAST_WORDS) & ~F.col("label_lang").eqNullSafe(F.col("lang"))
    part = (F.col("para_no") > 0) & (F.col("words") >= LEAST_WORDS) & (F.col("lang") != F.col("main_lang"))
    return judged.where(whole | part).select("doc_id", F.col("para_no").cast("long").alias("para_no"), "lang")


QUERIES = {"p9_found": p9_found, "p9_languages": p9_languages}
