"""License scans: a trained paragraph classifier, confirmed by templates.

A paragraph is a line that holds a word; words are lower-cased runs without
blanks, stripped of punctuation at their ends.  Features are the words and
word pairs of the licence templates (binary); a multinomial logistic
regression (FTRL, elastic net) tells the licence families and ``none`` apart.

Training rows: every template, alone and in ``variants`` altered copies
(corpus words before and after, single words dropped), and the families' names
as lines of their own; for ``none``, decoys
and a bounded sample of about ``negatives`` corpus paragraphs (documents with
the smallest id hashes, of at most ``longest`` characters) that no template
confirms.  A temperature is fitted
on every fifth row, and the probability a family needs is the least that lets
pass at most ``false_rate`` of the held-out ``none`` rows (0.5 at least).

Units.  Every line is classified, a line of over ``WINDOW`` words by overlapping
windows of so many; and so are overlapping windows over neighbouring lines that
no blank line parts, as notices are often wrapped.  A window without five
template words in a row cannot be confirmed and is passed over.

A unit whose probability of ``none`` is below 0.5 is looked at.  If it is some
licence by that bound, the families with a share of ``SHARE`` are compared, the
likeliest first, and the first that the comparison confirms is reported.  Its
words are taken out and the rest is judged again, so a line may hold several
notices.  A line of which
no family is confirmed is reported as ``unknown``, unless a confirmed notice runs
through it.  The comparison takes five-word shingles (all words of a shorter
unit): a template is confirmed if 0.8 of its shingles are in the unit (a window
with half a window of words on either side), or 0.8 of the unit's in it.

Every paragraph of every text is classified; the model (a few thousand
features) is bounded by the templates, not by the corpus.  No shuffle.

Defined results: null and empty texts have no paragraphs; repeated rows are
judged each; other columns are kept.
"""

from __future__ import annotations

import itertools
import random
from collections.abc import Iterator
from dataclasses import dataclass, field

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tierline.llm.langid import calibrate, fit_ftrl, softmax
from tierline.llm.license_templates import DECOYS, NAMES, TEMPLATES

SHINGLE, SIMILAR = 5, 0.8
WINDOW, SHARE = 64, 0.1
_EDGE = "\"'`.,;:!?()[]{}<>*#|_-/\\"
FOUND = "array<struct<paragraph: int, family: string, score: double, similarity: double>>"


def words_of(paragraph: str) -> list[str]:
    return [w for w in (x.strip(_EDGE) for x in paragraph.lower().split()) if w]


def shingles(words: list[str], width: int = SHINGLE) -> set[tuple[str, ...]]:
    w = min(width, len(words))
    return {tuple(words[i:i + w]) for i in range(len(words) - w + 1)} if w else set()


@dataclass
class LicenseModel:
    families: list[str]              # without ``none``, which is the last class
    word: dict[str, int]             # template words
    pairs: np.ndarray                # sorted codes of template word pairs
    weights: np.ndarray              # (words + pairs + bias) x classes
    templates: dict[str, list[list[str]]]        # their words
    temperature: float = 1.0
    bound: float = 0.5
    cut: dict = field(default_factory=dict, repr=False)          # template shingles by family and width

    def features(self, ids: np.ndarray, line: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """(line, feature) once each, from word numbers (-1: not a template's)."""
        n = len(self.word)
        known = ids >= 0
        both = known[:-1] & known[1:] & (line[:-1] == line[1:])
        code = ids[:-1][both] * n + ids[1:][both]
        at = np.searchsorted(self.pairs, code)
        hit = at < len(self.pairs)
        hit[hit] = self.pairs[at[hit]] == code[hit]
        feats = np.concatenate([ids[known], n + at[hit]])
        lines = np.concatenate([line[known], line[:-1][both][hit]])
        total = n + len(self.pairs) + 1
        code = np.unique(lines * total + feats)
        return code // total, code % total

    def probabilities(self, ids: np.ndarray, line: np.ndarray, n_lines: int) -> np.ndarray:
        lines, feats = self.features(ids, line)
        x = np.repeat(self.weights[-1:], n_lines, axis=0)
        np.add.at(x, lines, self.weights[feats])
        return softmax(x / self.temperature)

    def pair_hits(self, ids: np.ndarray) -> np.ndarray:
        """Whether each word and its next are neighbours in a template."""
        code = np.where((ids[:-1] >= 0) & (ids[1:] >= 0), ids[:-1] * len(self.word) + ids[1:], -1)
        at = np.minimum(np.searchsorted(self.pairs, code), len(self.pairs) - 1)
        return self.pairs[at] == code

    def compared(self, words: list[str], family: str) -> tuple[float, set]:
        """The greatest similarity to a template of the family, and the shared
        shingles."""
        width = min(SHINGLE, len(words))
        own = shingles(words, width)
        best = (0.0, set())
        if (family, width) not in self.cut:
            self.cut[family, width] = [shingles(text, width) for text in self.templates[family]]
        for t in self.cut[family, width] if width > 1 else ():
            both = own & t
            near = len(both) / min(len(t), len(own))
            if near > best[0]:
                best = near, both
        return best

    def similarity(self, words: list[str], family: str) -> float:
        return self.compared(words, family)[0]

    def judge(self, p: np.ndarray, words: list[str]) -> list[tuple[str, float, float, int, int]]:
        """The confirmed families of a unit with probabilities ``p``: name,
        probability, similarity, first and last word that confirm it.  The words
        of a confirmed notice are taken out and the rest is classified again."""
        out, left = [], list(range(len(words)))
        while 1 - p[-1] >= self.bound:
            rest = [words[i] for i in left]
            for k in np.argsort(-p[:-1], kind="stable").tolist():
                near, both = self.compared(rest, self.families[k]) if p[k] >= SHARE else (0.0, set())
                if near >= SIMILAR:
                    break
            else:
                break
            width = len(next(iter(both)))
            hit = {i + j for i in range(len(rest) - width + 1) if tuple(rest[i:i + width]) in both for j in range(width)}
            out.append((self.families[k], float(p[k]), near, left[min(hit)], left[max(hit)]))
            left = [x for i, x in enumerate(left) if i not in hit]
            if len(left) < 2:
                break
            ids = _numbers([words[i] for i in left], self.word)
            p = self.probabilities(ids, np.zeros(len(ids), np.int64), 1)[0]
        return out


def _numbers(words: list[str], word: dict[str, int]) -> np.ndarray:
    return np.array([word.get(w, -1) for w in words], np.int64)


def train(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", negatives: int = 4000,
          variants: int = 30, false_rate: float = 0.001, longest: int = 4000) -> LicenseModel:
    lines = docs.select(F.col(id_col).alias("i"), F.explode(F.split(F.coalesce(F.col(text_col), F.lit("")), "\n")).alias("p"))
    lines = lines.filter(f"p rlike '\\\\S' and length(p) <= {int(longest)}")
    spot = F.pmod(F.xxhash64(F.col("i").cast("string"), F.col("p")), F.lit(1 << 30))
    total = max(1, lines.count())
    drawn = sorted(r["p"] for r in lines.filter(spot < F.lit(int(min(1.0, negatives / total) * (1 << 30)))).select("p").collect())
    templates = {f: [words_of(t) for t in [*ts, *NAMES[f]]] for f, ts in TEMPLATES.items()}
    families = sorted(TEMPLATES)
    vocabulary = sorted({w for ts in templates.values() for t in ts for w in t})
    word = {w: i for i, w in enumerate(vocabulary)}
    pairs = np.array(sorted({word[a] * len(word) + word[b] for ts in templates.values() for t in ts
                             for a, b in itertools.pairwise(t)}), np.int64)
    model = LicenseModel(families, word, pairs, np.zeros((len(word) + len(pairs) + 1, len(families) + 1)), templates)

    none = [words_of(p) for p in drawn]
    none = [w for w in none if w and not any(model.similarity(w, f) >= SIMILAR for f in families)]
    rng = random.Random(5)
    rows = [(w, len(families)) for w in none] + [(words_of(d), len(families)) for d in DECOYS for _ in range(variants)]
    for k, f in enumerate(families):
        rows += [(words_of(t), k) for t in NAMES[f] for _ in range(variants)]
        for t in TEMPLATES[f]:
            words = words_of(t)
            rows.append((words, k))
            for _ in range(variants):
                kept = [w for w in words if rng.random() > 0.04] if len(words) > 8 else list(words)
                around = [rng.choice(none)[:rng.randint(0, 12)] if none else [] for _ in range(2)]
                rows.append((around[0] + kept + around[1], k))
    rng.shuffle(rows)
    data = []
    for w, k in rows:
        ids = _numbers(w, word)
        _, feats = model.features(ids, np.zeros(len(ids), np.int64))
        cols = np.append(feats, len(model.weights) - 1)
        data.append((cols, np.ones(len(cols)), k))
    fit, held = [d for i, d in enumerate(data) if i % 5], data[::5]
    model.weights = fit_ftrl(fit, len(families) + 1, 0.3, 1.0, 0.05, 0.001, 4, len(model.weights))
    x, y = np.array([v @ model.weights[c] for c, v, _ in held]), np.array([k for *_, k in held])
    model.temperature = calibrate(x, y)
    p = softmax(x / model.temperature)[y == len(families)][:, :-1].max(axis=1)
    if len(p):
        model.bound = float(min(max(0.5, np.quantile(p, 1 - false_rate)), 0.95))
    return model


def _windows(lo: int, hi: int) -> list[tuple[int, int]]:
    """Overlapping windows over the words lo..hi."""
    if hi - lo <= WINDOW:
        return [(lo, hi)]
    starts = [*range(lo, hi - WINDOW, WINDOW // 2), hi - WINDOW]
    return [(a, a + WINDOW) for a in starts]


def units_of(ids: np.ndarray, line: np.ndarray, n_lines: int, hits: np.ndarray) -> list[tuple[int, int, int, int]]:
    """(from, to, region from, region to) of the word windows to classify beside
    the lines of at most ``WINDOW`` words."""
    if not len(hits):
        return []
    upto = np.concatenate([[0], np.cumsum(hits)])
    first = np.searchsorted(line, np.arange(n_lines + 1))        # of each line
    out, i = [], 0
    while i < n_lines:
        if first[i] == first[i + 1]:
            i += 1
            continue
        j = i
        while j < n_lines and first[j] < first[j + 1]:           # to the next blank line
            j += 1
        lo, hi = int(first[i]), int(first[j])
        if (j > i + 1 or hi - lo > WINDOW) and upto[min(hi, len(hits))] - upto[lo] >= SHINGLE - 1:
            for a, b in _windows(lo, hi):
                inside = hits[a:b - 1]
                row = np.diff(np.flatnonzero(np.concatenate([[True], ~inside, [True]])))     # hits in a row, plus one
                if row.max() >= SHINGLE and (line[a] != line[b - 1] or first[line[a] + 1] - first[line[a]] > WINDOW):
                    out.append((a, b, max(lo, a - WINDOW // 2), min(hi, b + WINDOW // 2)))
        i = j
    return out


def notices(model: LicenseModel, lines: list[str], ids: np.ndarray, line: np.ndarray, p: np.ndarray) -> list[dict]:
    """The licence notices of one text.  ``ids``, ``line``: template word number
    and line of every word; ``p``: probabilities by line."""
    found: list[tuple[int, int, dict]] = []                     # first and last word
    long = np.bincount(line, minlength=len(lines)) > WINDOW
    odd = [i for i in np.flatnonzero(p[:, -1] < 0.5).tolist() if not long[i]]
    unknown = []
    for i in odd:
        lo, hi = np.searchsorted(line, [i, i + 1])
        got = model.judge(p[i], words_of(lines[i]))
        found += [(int(lo) + a, int(lo) + b, {"paragraph": i, "family": f, "score": q, "similarity": near}) for f, q, near, a, b in got]
        if not got:
            unknown.append((int(lo), int(hi) - 1, {"paragraph": i, "family": "unknown", "score": float(1 - p[i][-1]),
                                                   "similarity": model.similarity(words_of(lines[i]), model.families[int(p[i][:-1].argmax())])}))
    units = units_of(ids, line, len(lines), model.pair_hits(ids)) if len(ids) > 1 else []
    if units:
        at = np.concatenate([np.arange(a, b) for a, b, _, _ in units])
        which = np.repeat(np.arange(len(units)), [b - a for a, b, _, _ in units])
        q = model.probabilities(ids[at], which, len(units))
        words = [w for ln in lines for w in words_of(ln)] if (q[:, -1] < 0.5).any() else []
        for u in np.flatnonzero(q[:, -1] < 0.5).tolist():
            _, _, lo, hi = units[u]
            for f, score, near, first, last in model.judge(q[u], words[lo:hi]):
                a, b = lo + first, lo + last
                # Mostly the words of a notice that is found already: no other notice.
                if not any(x <= b and a <= y and (d["family"] == f or 2 * (min(b, y) - max(a, x) + 1) > b - a + 1) for x, y, d in found):
                    found.append((a, b, {"paragraph": int(line[a]), "family": f, "score": score, "similarity": near}))
    found += [u for u in unknown if not any(x <= u[1] and u[0] <= y for x, y, _ in found)]
    return [d for _, _, d in sorted(found, key=lambda r: (r[0], r[2]["family"]))]


def scan(docs: DataFrame, model: LicenseModel, text_col: str = "text", out: str = "licences",
         count_col: str = "n_paragraphs") -> DataFrame:
    """``docs`` without the text, with ``count_col`` (lines with a word) and
    ``out``: the licence notices found (number of the line where it begins, from
    0, family or ``unknown``)."""
    rest = [f for f in docs.schema.fields if f.name not in (text_col, count_col, out)]
    kind = pa.list_(pa.struct([("paragraph", pa.int32()), ("family", pa.string()), ("score", pa.float64()), ("similarity", pa.float64())]))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        number: dict[str, int] = {}              # raw word -> template word number, grows to a million at most

        def of(w: str) -> int:
            i = number.get(w)
            if i is None:
                if len(number) >= 1_000_000:
                    number.clear()
                i = number[w] = model.word.get(w.strip(_EDGE), -2 if not w.strip(_EDGE) else -1)
            return i

        for b in batches:
            found, counts = [], []
            for t in b.column(b.schema.get_field_index(text_col)):
                lines = (t.as_py() or "").split("\n")
                split = [ln.lower().split() for ln in lines]
                n = np.array([len(w) for w in split])
                ids = np.fromiter((of(w) for ws in split for w in ws), np.int64, int(n.sum()))
                line = np.repeat(np.arange(len(lines)), n)
                full = ids != -2                 # pure punctuation is no word
                ids, line = ids[full], line[full]
                p = model.probabilities(ids, line, len(lines))
                counts.append(int((np.bincount(line, minlength=len(lines)) > 0).sum()))
                found.append(notices(model, lines, ids, line, p))
            yield pa.RecordBatch.from_arrays(
                [*(b.column(b.schema.get_field_index(f.name)) for f in rest), pa.array(counts, pa.int32()), pa.array(found, kind)],
                [*(f.name for f in rest), count_col, out])

    ddl = ", ".join([*(f"`{f.name}` {f.dataType.simpleString()}" for f in rest), f"`{count_col}` int", f"`{out}` {FOUND}"])
    return docs.select(*[f.name for f in rest], text_col).mapInArrow(run, ddl)
