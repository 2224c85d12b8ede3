"""Personal data: validated patterns, and a semi-Markov conditional random field for other spellings.

The patterns find what is written in the usual form; these spans always stay. Around places where personal
data may stand in another form (an address spelled with "at" and "dot", digits grouped otherwise), a
semi-Markov CRF scores whole candidate spans by features of the span, and a dynamic program over spans
of bounded length chooses boundaries and kinds together. A span is added only if the model gives it
enough probability and it overlaps no span of the patterns.

The model is trained on the driver from a sample of at most SAMPLE_WINDOWS windows of the corpus,
labelled by the patterns, and from their validated values respelled. Nothing is shuffled but the sample;
every text is read whole in one task, with memory in proportion to the longest text.
"""

from __future__ import annotations

import math
import random
import re
import zlib
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from reconlake.llm import workers

KINDS = ("email", "ip", "card", "phone")
#: Windows of the corpus that the model is trained on at most, and passes over them.
SAMPLE_WINDOWS = 600
EPOCHS = 8
#: Tokens of a candidate span at most, and the probability that an added span needs.
SPAN_TOKENS = 30
LEAST_PROBABILITY = 0.9

# The base patterns.
_AT_DOMAIN = re.compile(r"@[A-Za-z0-9-]+(?:\.[A-Za-z0-9-]+)+")
_LOCAL = frozenset("ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789._%+-")
_IP = re.compile(r"(?<![0-9])[0-9]++\.[0-9]++\.[0-9]++\.[0-9]++")
_CARD = re.compile(r"[0-9](?:[\x20-]?[0-9])+")
_PHONE = re.compile(r"\+[0-9][\x20().0-9-]+[0-9]")

_DIGIT = re.compile(r"[0-9]")
_TOKEN = re.compile(r"[^\W\d_]+|[0-9]+|\s|.", re.DOTALL)
#: Where personal data in another form may stand: an at sign or dot in brackets or words, the word at before
#: a dotted name, seven digits or more in groups, or four groups of one to three digits with dots.
_ANCHOR = re.compile(
    r"@|[\[({]\s?at\s?[\])}]|(?<=[\s\])}])(?:dot|DOT)(?=[\s\[({])|[\[({]\s?dot\s?[\])}]"
    r"|(?<![0-9])[0-9](?:[^\S\n]?[().\[\]/_-]{0,3}[^\S\n]?[0-9]){6,}"
    r"|(?<=[^\W_])[^\S\n]at[^\S\n](?=[a-z0-9-]+(?:\.[a-z0-9-]+)*\.[a-z]{2})"
    r"|(?<![0-9])[0-9]{1,3}(?:(?:[^\S\n]?[\[({][^\S\n]?\.[^\S\n]?[\])}][^\S\n]?|[^\S\n]\.[^\S\n]|\.)[0-9]{1,3}){3}(?![0-9])",
    re.IGNORECASE,
)
_CONTEXT = 60
_FEATURES = 1 << 15


def luhn(digits: str) -> bool:
    total = 0
    for place, char in enumerate(reversed(digits)):
        value = int(char) * (2 if place % 2 else 1)
        total += value - 9 if value > 9 else value
    return total % 10 == 0


def _is_octet(digits: str) -> bool:
    digits = digits.lstrip("0")
    return len(digits) <= 3 and int(digits or 0) <= 255


def _emails(text: str) -> Iterator[tuple[int, int]]:
    end = 0
    at = text.find("@")
    while at >= 0:
        start = at
        while start > end and text[start - 1] in _LOCAL:
            start -= 1
        match = _AT_DOMAIN.match(text, at) if start < at else None
        if match:
            end = match.end()
            yield start, end
        else:
            end = max(end, at + 1) if start == at else end
        at = text.find("@", max(at + 1, end))


def base_spans(text: str) -> list[tuple[int, int, int]]:
    """(start, kind, end) in code points, by start, then kind; kinds are places in KINDS."""
    found = []
    if "@" in text:
        found += [(s, 0, e) for s, e in _emails(text)]
    if _DIGIT.search(text):
        for m in _IP.finditer(text):
            if all(_is_octet(part) for part in m[0].split(".")):
                found.append((m.start(), 1, m.end()))
        for m in _CARD.finditer(text):
            digits = m[0].replace(" ", "").replace("-", "")
            if 12 <= len(digits) <= 19 and luhn(digits):
                found.append((m.start(), 2, m.end()))
        if "+" in text:
            for m in _PHONE.finditer(text):
                if 9 <= sum(c in "0123456789" for c in m[0]) <= 15:
                    found.append((m.start(), 3, m.end()))
    return sorted(found)


def windows(text: str) -> list[tuple[int, int]]:
    """Stretches within a line around the places where personal data may stand; they do not overlap."""
    found: list[tuple[int, int]] = []
    for m in _ANCHOR.finditer(text):
        start = max(text.rfind("\n", max(0, m.start() - _CONTEXT), m.start()) + 1, m.start() - _CONTEXT, 0)
        line_end = text.find("\n", m.end(), m.end() + _CONTEXT)
        end = line_end if line_end >= 0 else min(len(text), m.end() + _CONTEXT)
        if found and start <= found[-1][1]:
            found[-1] = (found[-1][0], max(end, found[-1][1]))
        else:
            found.append((start, end))
    return found


_AT = re.compile(r"@|\s?[\[({]\s?at\s?[\])}]\s?|\sat\s", re.IGNORECASE)
_DOT = re.compile(r"\.|\s?[\[({]\s?dot\s?[\])}]\s?|\sdot\s", re.IGNORECASE)
_ADDRESS = re.compile(r"[A-Za-z0-9._%+-]+")
# Frequent last labels of domains.
_TOPS = frozenset("com org net edu gov mil int info biz io ai app dev uk us de fr it es nl ch at be se no fi dk pl cz pt ru cn jp in br au ca nz eu".split())
# Words after which "at example.com" names a place, not a mailbox.
_ORDINARY = frozenset(
    "a all also am an and are as available back based be been books bought built but by can check come data day"
    " deals details do down etc find for found free from get given go guide had has have he held her here him his"
    " home hosted how i in is it its join just kept know learn left listed live located look looking made me meet"
    " meeting more my new no not now of off offered on online only or order our out over page people posted prices"
    " published purchased read registered released research right seen sell sent she shown site so sold some store"
    " taken that the their them then there these they this those time today together up updated us used visit"
    " visiting was we website well were what when where which who will with work working works write yes you your".split()
)


def _email_features(span: str) -> list[str] | None:
    parts = _AT.split(span)
    if len(parts) != 2:
        return None
    local, domain = parts
    labels = _DOT.split(domain)
    if len(labels) < 2:
        return None
    at = _AT.search(span)[0]
    local_labels = _DOT.split(local)
    word_dots = _DOT.search(domain)[0].strip(" []{}()").lower() == "dot"
    if at.strip().isalpha() and not word_dots and local.lower() in _ORDINARY:
        return None
    spaced = any(" " in x or not x for x in [*labels, *local_labels])
    return [
        "at:" + ("sign" if at == "@" else "bracket" if at.strip() != at.strip(" []{}()") else "word"),
        "dot:" + ("word" if word_dots else "sign"),
        f"at-dot:{at.strip(' []{}()').lower()}:{word_dots}",
        "local:" + str(bool(all(_ADDRESS.fullmatch(x) for x in local_labels))),
        "labels:" + str(bool(all(re.fullmatch(r"[A-Za-z0-9-]+", x) for x in labels))),
        f"n-labels:{min(len(labels), 5)}",
        f"spaced:{spaced}",
        f"top-known:{labels[-1].lower() in _TOPS}:{word_dots}",
        "top:" + ("short" if re.fullmatch(r"[A-Za-z]{2,6}", labels[-1]) else "odd"),
        f"local-labels:{min(len(local_labels), 4)}",
    ]


def _digit_features(span: str) -> list[str] | None:
    groups = re.findall(r"[0-9]+", span)
    digits = "".join(groups)
    if not 4 <= len(digits) <= 24:
        return None
    between = re.split(r"[0-9]+", span)
    marks = sorted({m.strip() or m for m in between[1:-1]})
    shape = "-".join(str(len(g)) for g in groups) if len(groups) <= 6 else "many"
    octets = len(groups) == 4 and all(map(_is_octet, groups))
    valid = 12 <= len(digits) <= 19 and luhn(digits)
    lead = between[0]
    return [
        f"digits:{len(digits)}", f"shape:{shape}", "marks:" + "".join(marks)[:8], f"octets:{octets}",
        f"octets-marks:{octets}:" + "".join(marks)[:8], f"octets-between:{octets}:" + "|".join(sorted(set(between[1:-1])))[:12], f"luhn:{valid}", f"luhn-digits:{valid}:{len(digits)}",
        f"lead:{lead}", f"balanced:{span.count('(') == span.count(')')}", f"groups:{min(len(groups), 7)}",
        f"shape-marks:{shape}:" + "".join(marks)[:8], f"shape-lead:{shape}:{lead}",
        f"even:{len({len(g) for g in groups}) == 1}",
    ]


def _ids(kind: int, names: list[str]) -> np.ndarray:
    return np.array([zlib.crc32(f"{kind}|{n}".encode()) % _FEATURES for n in ["bias", *names]], np.int64)


@dataclass
class Lattice:
    """Token ends of a window, and its candidate spans: first token, token after the last, kind, features."""

    bounds: list[int]
    spans: list[tuple[int, int, int, np.ndarray]]


def lattice(window: str) -> Lattice:
    tokens = [m[0] for m in _TOKEN.finditer(window)]
    bounds = [0]
    for t in tokens:
        bounds.append(bounds[-1] + len(t))
    spans = []
    solid = [t[0].isalnum() for t in tokens]
    for i, first in enumerate(tokens):
        if first.isspace() or (i and solid[i - 1]) or not (solid[i] or first in "+("):
            continue
        letters = digits = 0
        for j in range(i + 1, min(i + SPAN_TOKENS, len(tokens)) + 1):
            last = tokens[j - 1]
            letters += last[0].isalpha()
            digits += len(last) if last[0].isdigit() else 0
            if not solid[j - 1] or (j < len(tokens) and solid[j]):
                continue
            span = window[bounds[i] : bounds[j]]
            around = [
                "left:" + (window[bounds[i] - 1] if bounds[i] else "^"),
                "right:" + (window[bounds[j]] if bounds[j] < len(window) else "$"),
            ]
            if letters:
                names = _email_features(span) if solid[i] else None
                if names:
                    spans.append((i, j, 0, _ids(0, names + around)))
            elif digits >= 4:
                names = _digit_features(span)
                if names:
                    spans += [(i, j, kind, _ids(kind, names + around)) for kind in (1, 2, 3)]
    return Lattice(bounds, spans)


def _add_logs(a: float, b: float) -> float:
    low, high = (a, b) if a < b else (b, a)
    return high if low == -math.inf else high + math.log1p(math.exp(low - high))


def _sums(n: int, spans: list, scores: np.ndarray) -> tuple[list[float], list[float]]:
    """Log sums over all segmentations of what lies before, and after, each token boundary."""
    ending: list[list[int]] = [[] for _ in range(n + 1)]
    starting: list[list[int]] = [[] for _ in range(n + 1)]
    for c, (i, j, _, _) in enumerate(spans):
        ending[j].append(c)
        starting[i].append(c)
    before, after = [0.0] * (n + 1), [0.0] * (n + 1)
    for k in range(1, n + 1):
        total = before[k - 1]
        for c in ending[k]:
            total = _add_logs(total, before[spans[c][0]] + scores[c])
        before[k] = total
    for k in range(n - 1, -1, -1):
        total = after[k + 1]
        for c in starting[k]:
            total = _add_logs(total, scores[c] + after[spans[c][1]])
        after[k] = total
    return before, after


def probabilities(of: Lattice, weights: np.ndarray) -> np.ndarray:
    scores = np.array([weights[f].sum() for *_, f in of.spans])
    before, after = _sums(len(of.bounds) - 1, of.spans, scores)
    return np.array([math.exp(min(0.0, before[i] + s + after[j] - before[-1])) for (i, j, *_), s in zip(of.spans, scores)])


def train(examples: list[tuple[str, list[tuple[int, int, int]]]], epochs: int = EPOCHS, rate: float = 0.3) -> np.ndarray:
    """Weights that raise the probability of the given segmentations, by adaptive gradient steps.

    An example is a window and its spans (start, kind, end). Steps are in a fixed order: reruns agree.
    """
    made = []
    for window, labels in examples:
        of = lattice(window)
        wanted = {(s, k, e) for s, k, e in labels}
        truth = np.array([(of.bounds[i], k, of.bounds[j]) in wanted for i, j, k, _ in of.spans], float)
        if of.spans:
            made.append((of, truth))
    weights, squares = np.zeros(_FEATURES), np.full(_FEATURES, 1e-3)
    order = random.Random(3)
    for _ in range(epochs):
        order.shuffle(made)
        for of, truth in made:
            push = truth - probabilities(of, weights)
            step = np.zeros(0)
            for c, (*_, features) in enumerate(of.spans):
                if abs(push[c]) > 1e-3:
                    step = push[c] - 1e-3 * weights[features]
                    np.add.at(squares, features, step * step)
                    np.add.at(weights, features, rate * step / np.sqrt(squares[features]))
    return weights


def best_spans(of: Lattice, weights: np.ndarray, barred: list[tuple[int, int]]) -> list[tuple[int, int, int]]:
    """The most probable segmentation that overlaps no barred stretch: (start, kind, end) in the window."""
    free = [
        (i, j, k, f) for i, j, k, f in of.spans
        if all(of.bounds[j] <= s or e <= of.bounds[i] for s, e in barred)
    ]
    if not free:
        return []
    scores = [float(weights[f].sum()) for *_, f in free]
    n = len(of.bounds) - 1
    ending: list[list[int]] = [[] for _ in range(n + 1)]
    for c, (_, j, _, _) in enumerate(free):
        ending[j].append(c)
    value, choice = [0.0] * (n + 1), [-1] * (n + 1)
    for k in range(1, n + 1):
        value[k] = value[k - 1]
        for c in ending[k]:
            if value[free[c][0]] + scores[c] > value[k]:
                value[k], choice[k] = value[free[c][0]] + scores[c], c
    chosen, k = [], n
    while k > 0:
        if choice[k] < 0:
            k -= 1
        else:
            chosen.append(choice[k])
            k = free[choice[k]][0]
    if not chosen:
        return []
    sure = probabilities(Lattice(of.bounds, free), weights)
    return sorted(
        (of.bounds[free[c][0]], free[c][2], of.bounds[free[c][1]]) for c in chosen if sure[c] >= LEAST_PROBABILITY
    )


def all_spans(text: str, base: list[tuple[int, int, int]], weights: np.ndarray) -> list[tuple[int, int, int]]:
    barred = [(s, e) for s, _, e in base]
    found = list(base)
    for start, end in windows(text):
        # an address in the usual form needs no model
        near = [(s - start, e - start) for s, e in barred if s < end and e > start]
        added = best_spans(lattice(text[start:end]), weights, near)
        found += [(s + start, k, e + start) for s, k, e in added]
    return sorted(found)


def respelled(kind: int, value: str, choose: random.Random) -> str:
    """A validated value in another form."""
    if kind == 0:
        at, dot = choose.choice([(" at ", " dot "), (" [at] ", " [dot] "), ("(at)", "."), (" (at) ", " (dot) "), ("[at]", "[dot]"), (" at ", ".")])
        local, domain = value.split("@")
        return local + at + domain.replace(".", dot)
    digits = [c for c in value if c in "0123456789"]
    if kind == 1:
        return choose.choice(["[.]", " . ", "(.)", "[.]"]).join(value.split("."))
    if kind == 2:
        mark = choose.choice([".", "/", " - ", "_"])
        return mark.join("".join(digits[i : i + 4]) for i in range(0, len(digits), 4))
    last = "".join(digits[-10:])
    form = choose.choice(["({}) {}-{}", "{}-{}-{}", "{}.{}.{}", "({}){}-{}", "1-{}-{}-{}"])
    return form.format(last[:3], last[3:6], last[6:])


def _harmless(choose: random.Random) -> str:
    """Something with digits, or with at and dot, that is no personal data."""
    number = lambda n: "".join(choose.choice("0123456789") for _ in range(n))
    card = number(16)
    while luhn(card):
        card = number(16)
    return choose.choice(
        [
            f"20{number(2)}-{choose.randint(1, 12):02}-{choose.randint(1, 28):02}", f"{number(3)},{number(3)},{number(3)}",
            f"{number(1)}.{number(1)}.{number(2)}", card, ".".join(card[i : i + 4] for i in range(0, 16, 4)), number(8),
            number(choose.randint(9, 14)), f"{number(4)}-{number(4)}", f"978-{number(1)}-{number(4)}-{number(4)}-{number(1)}",
            f"{number(2)}:{number(2)}:{number(2)}.{number(3)}", f"{choose.randint(300, 999)} . {number(2)} . {number(2)} . {number(2)}",
            f"{number(1)}. {number(1)}. {number(1)}. {number(1)}.", f"{number(6)}/{number(6)}", "look at the dot on", "met at noon dot and", f"{number(40)}", f"#{number(7)}",
            f"{number(3)}.{number(3)}.{number(3)}.{number(3)}.{number(3)}", f"{number(5)} {number(5)} {number(5)} {number(5)}",
        ]
    )


def _made_up(kind: int, choose: random.Random) -> str:
    """A valid value in the usual form, whatever the corpus holds."""
    number = lambda n: "".join(choose.choice("0123456789") for _ in range(n))
    if kind == 0:
        local = choose.choice(["jo", "k.b", "info", "ann.lee", "x_" + number(2), "mail.44"])
        domain = choose.choice(["a", "site1", "post", "mail3.example", "x.y"])
        return f"{local}@{domain}.{choose.choice(['org', 'de', 'net', 'com', 'info'])}"
    if kind == 1:
        # one in three has short parts only, as private and resolver addresses have
        most = choose.choice([9, 255, 255])
        return ".".join(str(choose.randint(0, most)) for _ in range(4))
    if kind == 2:
        body = number(15)
        return next(body + c for c in "0123456789" if luhn(body + c))
    return f"+{choose.randint(1, 99)} ({number(3)}) {number(3)}-{number(4)}"


def examples(sample: list[str], seed: int = 11) -> list[tuple[str, list[tuple[int, int, int]]]]:
    """Training windows: the sample as the patterns label it, and values respelled, and harmless ones.

    Half of the values come from the sample, if it has any, and half are made up.
    """
    choose = random.Random(seed)
    values: list[list[str]] = [[] for _ in KINDS]
    for window in sample:
        for s, k, e in base_spans(window):
            values[k].append(window[s:e])
    made = [(w, base_spans(w)) for w in sample]
    carriers = [re.sub(r"[0-9@]", "", w)[:50] for w in sample] or ["it was sent to", "ask", ""]
    for n in range(SAMPLE_WINDOWS):
        kind = n % len(KINDS)
        own = values[kind] if choose.random() < 0.5 else []
        value = choose.choice(own) if own else _made_up(kind, choose)
        other, before, after = respelled(kind, value, choose), choose.choice(carriers), choose.choice(carriers)
        before, after = before + choose.choice([" ", ": ", " "]), choose.choice([" ", ". ", ", ", " "]) + after
        made.append((before + other + after, [(len(before), kind, len(before) + len(other))]))
        made.append((before + _harmless(choose) + after, []))
    return made


def sample_windows(docs: DataFrame, text: str) -> list[str]:
    """At most SAMPLE_WINDOWS distinct windows of the corpus, chosen by their hash."""

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            found = sorted({t[s:e][:400] for t in batch.column(0).to_pylist() for s, e in windows(t)})
            yield pa.RecordBatch.from_pydict({"w": pa.array(found, pa.string())})

    named = docs.select(F.col(f"`{text}`").alias("t")).where("t IS NOT NULL").mapInArrow(cut, "w string")
    rows = named.distinct().orderBy(F.xxhash64("w"), "w").limit(SAMPLE_WINDOWS).collect()
    return [r["w"] for r in rows]


def fit(docs: DataFrame, text: str = "text") -> np.ndarray:
    """The model's weights (an array of fixed length)."""
    workers.importable(docs.sparkSession)
    return train(examples(sample_windows(docs, text)))


def _listed(spans: list[tuple[int, int, int]]) -> str:
    return ",".join(f"{KINDS[k]}:{s}:{e}" for s, k, e in spans)


def find_personal_data(docs: DataFrame, weights: np.ndarray, text: str = "text", id_column: str = "doc_id") -> DataFrame:
    """doc_id, the number of pattern spans of each kind, and base and all spans as text, of every row.

    Spans are ``kind:start:end`` in code points, end exclusive, by start, then kind, joined by commas. A NULL
    or empty text has none; repeated rows give repeated results; an empty table gives none.
    """
    spark = docs.sparkSession
    workers.importable(spark)
    shared = spark.sparkContext.broadcast(weights)
    counts = ", ".join(f"n_{kind} long" for kind in KINDS)

    @F.pandas_udf(f"{counts}, base string, spans string")
    def scan(batches: Iterator[pd.Series]) -> Iterator[pd.DataFrame]:
        for texts in batches:
            rows = []
            for whole in texts:
                base = base_spans(whole) if whole else []
                every = all_spans(whole, base, shared.value) if whole else []
                numbers = [sum(k == kind for _, k, _ in base) for kind in range(len(KINDS))]
                rows.append((*numbers, _listed(base), _listed(every)))
            yield pd.DataFrame(rows, columns=[*(f"n_{kind}" for kind in KINDS), "base", "spans"])

    named = docs.select(F.col(f"`{id_column}`").alias("doc_id"), F.col(f"`{text}`").alias("t"))
    return named.select("doc_id", scan("t").alias("p")).select("doc_id", "p.*")
