"""Personal data: exact patterns, and a linear-chain conditional random field over word shapes that adds spans.

The patterns are the base and always stay: email, ip, card and phone, leftmost and without overlap within a kind. The field labels
the words of a text as outside, or as the beginning or inside of a kind. It is trained on a small labelled table, by gradient
steps on the conditional likelihood, and decoded by Viterbi over batches of word runs in numpy. Its spans are added where no base
span is touched, so it finds what the patterns miss by form: numbers without a valid check digit, phones without a plus sign, and
secrets such as keys and tokens, a kind of its own. The table is filled from patterns with made-up digits and letters.

A word without digit and without @ is outside by construction, so a text's best labelling falls apart into its runs of other
words, and only these are decoded; that is the same result, not a short cut.

Offsets are code points, ends exclusive. Defined cases: a NULL or empty text has no spans; repeated rows get equal rows; an empty
labelled table adds nothing; columns other than doc_id and text are ignored. All patterns take time in proportion to the text.
"""

from __future__ import annotations

import random
import re
from collections.abc import Callable, Iterable, Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame

from hostpulse.llm.tokens import small_batches

KINDS = ["email", "ip", "card", "phone"]
#: Kinds of spans: those of the patterns, and keys and tokens, which only the field finds.
FOUND = [*KINDS, "secret"]
LABELS = ["O", *(f"{side}-{kind}" for kind in FOUND for side in "BI")]
#: Lines of the labelled table; [kind:slot] marks a span that is filled with made-up digits and letters, {slot} fills outside of any
#: span. Nothing here is taken from a corpus.
PATTERNS = """
write to [email:mail] before noon
his address is [email:mail], hers is [email:mail]
from [email:mail] to [email:mail]
the server at [ip:ip] did not answer
login from [ip:ip] failed, then from [ip:ip]
ping [ip:ip]
card [card:card] was charged
charge it to [card:spaced] please
her number is [card:dashed] and it expires soon
[card:card] thank you
cards [card:card] and [card:amex] are lost
call [phone:plus] today
ring me at [phone:area] tonight
office [phone:dashes] is open
reach us under [phone:local]
the fax is [phone:plus], the phone [phone:area]
token = "[secret:hex]" is set
api_key: [secret:mixed]
password "[secret:hex]" in the file
export SECRET=[secret:prefixed]
the bearer [secret:mixed] was sent
"[secret:hex]"
use [secret:prefixed] for now
commit {hash} was fine
the checksum {hash} of it
licensed under version {small}.{small} of the terms
see chapter {small} on page {small}
in {year} there were {small} people
on {year}-{two}-{two} at {two}:{two} we met
the price is ${small}.{two} or {small},{three}.{two} in total
python {small}.{small}.{small} and spark {small}.{small} run well
about {small}.{small} million rows and {small} columns
room {three}, floor {small}, seat {two}b
it grew by {small}% in {year}-{year}
the {small}rd of {small} and the {small}nd of {two}
{two} {two} {two} {two} {two}
win {three}0000 points at {three} to {small}
figure {small}b and table {two}a
@home and @work are words
a {small}-{small} win and a {two}-{small} loss
x{small} y{small} z{small}
order {six} of {year}
"""
#: Times that every pattern is filled.
FILLINGS = 8
EPOCHS = 25
RATE = 0.5
DECAY = 1e-3
_WORD = re.compile(r"[^\x20\x09-\x0D]+")
_MARK = re.compile(r"\[(\w+):([^\]]*)\]")
_TELLING = re.compile("[0-9@]")
_EDGE = "\"'`.,;:!?*#$%&<>[]{}|=~^"
_DOMAIN = re.compile(r"[A-Za-z0-9-]+(?:\.[A-Za-z0-9-]+)+")
_LOCAL = frozenset("ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789._%+-")
_DOTTED = re.compile(r"[0-9]+(?:\.[0-9]+)*")
_CARD = re.compile(r"[0-9](?:[\x20-]?[0-9])+")
_PHONE = re.compile(r"\+[0-9][\x20().0-9-]+[0-9]")
_DIGIT = re.compile(r"[0-9]")
_HEX = re.compile(r"[0-9a-f]+|[0-9A-F]+")
#: Added to the score of a label that a word's form rules out.
_BARRED = -1e9
_ROUGH = str.maketrans(
    "ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789", "X" * 26 + "x" * 26 + "d" * 10
)
Span = tuple[int, int]


# ---- the labelled table ----------------------------------------------------------------------------------------------------

def _slots(rng: random.Random) -> dict[str, Callable[[], str]]:
    """Made-up values by slot."""
    def digits(n: int) -> str:
        return "".join(rng.choice("0123456789") for _ in range(n))

    def letters(n: int, of: str = "abcdefghijklmnopqrstuvwxyz") -> str:
        return "".join(rng.choice(of) for _ in range(n))

    def mixed(n: int) -> str:
        word = letters(n, "abcdefghijklmnopqrstuvwxyzABCDEFGHIJKLMNOPQRSTUVWXYZ0123456789")
        return word if any(map(str.isdigit, word)) else word[:-1] + digits(1)

    def hexed(n: int) -> str:
        word = letters(n, "0123456789abcdef")
        return word if any(map(str.isdigit, word)) else digits(1) + word[1:]

    return {
        "mail": lambda: f"{letters(rng.randint(2, 7))}{rng.choice(['', '.', '_', '-'])}{letters(4)}{digits(rng.randint(0, 2))}"
        f"@{letters(rng.randint(3, 8))}.{rng.choice(['', letters(5) + '.'])}{letters(rng.randint(2, 3))}",
        "ip": lambda: ".".join(str(rng.randint(0, 255)) for _ in range(4)),
        "card": lambda: digits(16), "amex": lambda: digits(15), "spaced": lambda: " ".join(digits(4) for _ in range(4)),
        "dashed": lambda: "-".join(digits(4) for _ in range(4)),
        "plus": lambda: f"+{rng.randint(1, 98)} {rng.choice(['(' + digits(3) + ')', digits(2)])} {digits(3)}{rng.choice(' -')}{digits(4)}",
        "area": lambda: f"({digits(3)}) {digits(3)}-{digits(4)}", "dashes": lambda: f"{digits(3)}-{digits(3)}-{digits(4)}",
        "local": lambda: f"0{digits(2)}-{digits(6)}-{digits(2)}",
        "hex": lambda: (str.upper if rng.random() < 0.3 else str)(hexed(rng.choice([32, 40, 40, 48, 64]))),
        "mixed": lambda: mixed(rng.randint(20, 44)), "prefixed": lambda: f"{letters(2)}{rng.choice('-_')}{mixed(rng.randint(18, 36))}",
        "hash": lambda: hexed(rng.choice([7, 8, 10, 12])), "small": lambda: str(rng.randint(1, 99)), "two": lambda: digits(2),
        "three": lambda: digits(3), "six": lambda: digits(6), "year": lambda: str(rng.randint(1900, 2099)),
    }


def labelled(patterns: str = PATTERNS, fillings: int = FILLINGS, seed: int = 11) -> list[str]:
    """The labelled table: every pattern filled several times, [kind:surface] marks a span."""
    slots = _slots(random.Random(seed))
    lines = [line for line in patterns.strip().split("\n") for _ in range(fillings)]
    lines = [re.sub(r"\[(\w+):(\w+)\]", lambda m: f"[{m[1]}:{slots[m[2]]()}]", line) for line in lines]
    return [re.sub(r"\{(\w+)\}", lambda m: slots[m[1]](), line) for line in lines]


# ---- base patterns ---------------------------------------------------------------------------------------------------------

def emails(text: str) -> list[Span]:
    """Found from the @ outwards, so that a long word without one costs nothing."""
    found, free, at = [], 0, text.find("@")
    while at >= 0:
        start = at
        while start > free and text[start - 1] in _LOCAL:
            start -= 1
        domain = _DOMAIN.match(text, at + 1)
        if domain and start < at:
            found.append((start, domain.end()))
            free = domain.end()
        at = text.find("@", max(at + 1, free))
    return found


def ips(text: str) -> list[Span]:
    """Runs of dotted numbers, taken four by four from the left."""
    found = []
    for run in _DOTTED.finditer(text):
        parts, at = run[0].split("."), run.start()
        for k in range(0, len(parts) - 3, 4):
            four = parts[k:k + 4]
            end = at + sum(map(len, four)) + 3
            if all(len(p.lstrip("0")) <= 3 and int(p[-4:]) <= 255 for p in four):
                found.append((at, end))
            at = end + 1
    return found


def luhn(digits: str) -> bool:
    total = 0
    for k, d in enumerate(reversed(digits)):
        v = int(d) * (1 + k % 2)
        total += v - 9 if v > 9 else v
    return total % 10 == 0


def cards(text: str) -> list[Span]:
    found = []
    for m in _CARD.finditer(text):
        digits = m[0].replace(" ", "").replace("-", "")
        if 13 <= len(digits) <= 19 and luhn(digits):
            found.append(m.span())
    return found


def phones(text: str) -> list[Span]:
    return [m.span() for m in _PHONE.finditer(text) if 9 <= len(_DIGIT.findall(m[0])) <= 15]


def base_spans(text: str) -> dict[str, list[Span]]:
    return {"email": emails(text), "ip": ips(text), "card": cards(text), "phone": phones(text)}


# ---- word shapes -----------------------------------------------------------------------------------------------------------

def _shape(word: str) -> str:
    """Letters and digits by class, with the length of each run up to four."""
    return re.sub(r"(.)\1{3,}", r"\1\1\1+", word.translate(_ROUGH))


def features(words: list[str], k: int) -> list[str]:
    """Names of the features of word k: shapes of it and its neighbours, counts, and where it stands in its run."""
    word, before, after = words[k], words[k - 1] if k else "", words[k + 1] if k + 1 < len(words) else ""
    digits, core = len(_DIGIT.findall(word)), word.strip(_EDGE)
    if len(core) > 12 and (core[0], core[-1]) == ("(", ")"):
        core = core[1:-1]
    hexed = bool(_HEX.fullmatch(core)) and not core.isdigit()
    lettered = bool(digits) and any(map(str.isalpha, core))
    said = next((w for w in (words[j].strip(_EDGE) for j in range(k - 1, max(k - 4, -1), -1)) if w), "")
    return [
        "bias", f"s={_shape(core)}", f"S={re.sub(r'(.)\1+', r'\1', core.translate(_ROUGH))}", f"n={min(digits, 20)}",
        f"dots={min(core.count('.'), 4)}", f"at={'@' in word}", f"dash={min(core.count('-'), 3)}", f"all={core.isdigit()}",
        f"mixed={lettered}", f"form={hexed}{lettered}{min(len(core), 32) // 8}{'@' in core}", f"first={core[:1].translate(_ROUGH)}", f"len={min(len(core), 40) // 2}",
        f"hex={hexed}", f"said={said.lower()[:20]}",
        f"p={_shape(before.strip(_EDGE))[:12] if _TELLING.search(before) else 'x'}",
        f"q={_shape(after.strip(_EDGE))[:12] if _TELLING.search(after) else 'x'}",
    ]


@dataclass(frozen=True)
class Field:
    """Weights of a linear-chain field: per feature and label, and per pair of following labels."""

    index: dict[str, int]
    weights: np.ndarray
    steps: np.ndarray

    def scores(self, words: list[str], k: int) -> np.ndarray:
        known = [self.index[f] for f in features(words, k) if f in self.index]
        return self.weights[known].sum(0) + _barred(words[k])


def _barred(word: str) -> np.ndarray:
    """0 for the labels that a word may have: an email begins with a word that holds an @, and only an email does."""
    out = np.zeros(len(LABELS))
    for k, label in enumerate(LABELS):
        if label == "I-email" or label != "O" and (label == "B-email") != ("@" in word):
            out[k] = _BARRED
    return out


def _allowed() -> np.ndarray:
    """0 where label j may follow label i, else minus infinity: an inside label only follows its own kind."""
    out = np.zeros((len(LABELS), len(LABELS)))
    for i, a in enumerate(LABELS):
        for j, b in enumerate(LABELS):
            if b[0] == "I" and a[2:] != b[2:]:
                out[i, j] = -np.inf
    return out


def runs(words: list[str]) -> list[Span]:
    """Stretches of words that hold a digit or an @."""
    out, start = [], None
    for k, word in enumerate(words):
        if _TELLING.search(word):
            start = k if start is None else start
        elif start is not None:
            out.append((start, k))
            start = None
    return out if start is None else [*out, (start, len(words))]


def parse_labelled(lines: Iterable[str]) -> list[tuple[list[str], list[int]]]:
    """Words and label numbers of the runs of each line."""
    out = []
    for line in lines:
        plain, spans, at = "", [], 0
        for m in _MARK.finditer(line):
            plain += line[at:m.start()]
            spans.append((m[1], len(plain), len(plain) + len(m[2])))
            plain += m[2]
            at = m.end()
        plain += line[at:]
        places = [m.span() for m in _WORD.finditer(plain)]
        words = [plain[a:b] for a, b in places]
        labels = [0] * len(words)
        for kind, start, end in spans:
            inside = [k for k, (a, b) in enumerate(places) if a < end and b > start]
            for k in inside:
                labels[k] = LABELS.index(f"{'B' if k == inside[0] else 'I'}-{kind}")
        out += [(words, labels, a, b) for a, b in runs(words)]
    return out


def _sum_exp(x: np.ndarray, axis: int) -> np.ndarray:
    top = x.max(axis, keepdims=True)
    return (top + np.log(np.exp(x - top).sum(axis, keepdims=True))).squeeze(axis)


def train(lines: Iterable[str] | None = None, epochs: int = EPOCHS, rate: float = RATE, decay: float = DECAY) -> Field:
    """Stochastic gradient ascent (AdaGrad) on the log likelihood; order and start are fixed, so equal tables give equal fields."""
    examples = parse_labelled(labelled() if lines is None else lines)
    index: dict[str, int] = {}
    rows = []
    for words, labels, a, b in examples:
        found = [[index.setdefault(f, len(index)) for f in features(words, k)] for k in range(a, b)]
        rows.append((found, labels[a:b], np.stack([_barred(w) for w in words[a:b]])))
    size, allowed = len(LABELS), _allowed()
    weights, steps = np.zeros((len(index), size)), np.zeros((size, size))
    past_w, past_s = np.full_like(weights, 1e-6), np.full_like(steps, 1e-6)
    for _ in range(epochs):
        for found, labels, barred in rows:
            emit = np.stack([weights[f].sum(0) for f in found]) + barred
            move = steps + allowed
            n = len(labels)
            ahead, back = np.zeros((n, size)), np.zeros((n, size))
            ahead[0] = emit[0] + move[0]
            for t in range(1, n):
                ahead[t] = emit[t] + _sum_exp(ahead[t - 1][:, None] + move, 0)
            back[-1] = move[:, 0]
            for t in range(n - 2, -1, -1):
                back[t] = _sum_exp(move + (emit[t + 1] + back[t + 1])[None, :], 1)
            total = _sum_exp(ahead[-1] + back[-1], 0)
            marginal = -np.exp(ahead + back - total)
            pairs = np.zeros((size, size))
            pairs[0] += marginal[0]
            pairs[:, 0] += marginal[-1]
            for t in range(1, n):
                pairs -= np.exp(ahead[t - 1][:, None] + move + (emit[t] + back[t])[None, :] - total)
            chain = [0, *labels, 0]
            for x, y in zip(chain, chain[1:]):
                pairs[x, y] += 1
            marginal[np.arange(n), labels] += 1
            for f, g in zip(found, marginal):
                past_w[f] += g**2
                weights[f] += rate * (g - decay * weights[f]) / np.sqrt(past_w[f])
            past_s += pairs**2
            steps += rate * (pairs - decay * steps) / np.sqrt(past_s)
    return Field(index, weights, steps)


def viterbi(emit: list[np.ndarray], steps: np.ndarray) -> list[np.ndarray]:
    """Best labels of many runs at once, each from outside to outside; runs are advanced together, the longest first."""
    if not emit:
        return []
    move = steps + _allowed()
    order = sorted(range(len(emit)), key=lambda i: -len(emit[i]))
    lengths = np.asarray([len(emit[i]) for i in order])
    best = np.stack([emit[i][0] for i in order]) + move[0]
    back: list[np.ndarray] = []
    for t in range(1, int(lengths[0])):
        live = int(np.searchsorted(-lengths, -t, side="left"))
        paths = best[:live, :, None] + move
        back.append(paths.argmax(1))
        best[:live] = paths.max(1) + np.stack([emit[i][t] for i in order[:live]])
    last = (best + move[:, 0]).argmax(1)
    out: list[np.ndarray] = [np.empty(0)] * len(emit)
    for r, i in enumerate(order):
        labels = [int(last[r])]
        for t in range(len(emit[i]) - 2, -1, -1):
            labels.append(int(back[t][r, labels[-1]]))
        out[i] = np.asarray(labels[::-1])
    return out


def _tagged(field: Field, texts: list[str]) -> list[list[tuple[str, int, int]]]:
    """Spans that the field finds, per text."""
    emit, where = [], []
    for d, text in enumerate(texts):
        if not _TELLING.search(text):
            continue
        places = [m.span() for m in _WORD.finditer(text)]
        words = [text[a:b] for a, b in places]
        for a, b in runs(words):
            emit.append([field.scores(words, k) for k in range(a, b)])
            where.append((d, places[a:b]))
    out: list[list[tuple[str, int, int]]] = [[] for _ in texts]
    for (d, places), labels in zip(where, viterbi(emit, field.steps), strict=True):
        k = 0
        while k < len(labels):
            if not labels[k]:
                k += 1
                continue
            kind, end = LABELS[labels[k]][2:], k + 1
            while end < len(labels) and LABELS[labels[end]] == f"I-{kind}":
                end += 1
            a, b = places[k][0], places[end - 1][1]
            surface, edge = texts[d][a:b], _EDGE + "()" * (kind == "secret")
            a, b = a + len(surface) - len(surface.lstrip(edge)), b - (len(surface) - len(surface.rstrip(edge)))
            if a < b:
                out[d].append((kind, a, b))
            k = end
    return out


def find(texts: list[str], field: Field) -> list[tuple[dict[str, list[Span]], dict[str, list[Span]]]]:
    """Per text: base spans by kind, and all spans by kind; an added span touches no base span."""
    out = []
    for text, added in zip(texts, _tagged(field, texts), strict=True):
        base = base_spans(text) if _TELLING.search(text) else {k: [] for k in KINDS}
        taken = sorted(s for spans in base.values() for s in spans)
        every = {kind: list(base.get(kind, ())) for kind in FOUND}
        starts, reach = [s[0] for s in taken], np.maximum.accumulate([s[1] for s in taken]) if taken else []
        for kind, a, b in added:
            before = int(np.searchsorted(starts, b, side="left"))  # base spans that begin before the end of this one
            if not before or reach[before - 1] <= a:
                every[kind].append((a, b))
        out.append((base, {kind: sorted(spans) for kind, spans in every.items()}))
    return out


def _joined(spans: dict[str, list[Span]]) -> str:
    return ",".join(f"{kind}:{a}:{b}" for kind in FOUND for a, b in spans.get(kind, ()))


def _detect(field: Field):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for whole in batches:
            for batch in small_batches(whole):
                found = find([t or "" for t in batch["text"].to_pylist()], field)
                counts = [pa.array([len(base[k]) for base, _ in found], pa.int64()) for k in KINDS]
                yield pa.RecordBatch.from_arrays(
                    [batch["doc_id"], *counts, pa.array([_joined(b) for b, _ in found], pa.string()),
                     pa.array([_joined(e) for _, e in found], pa.string())],
                    ["doc_id", *(f"n_{k}" for k in KINDS), "base_spans", "spans"],
                )

    return run


def detect(docs: DataFrame, field: Field) -> DataFrame:
    """doc_id, base counts by kind, `base_spans` and `spans`: kind:start:end by kind, then start, joined by commas."""
    rows = docs.select("doc_id", "text")
    counts = ", ".join(f"n_{k} long" for k in KINDS)
    return rows.mapInArrow(_detect(field), f"doc_id {dict(rows.dtypes)['doc_id']}, {counts}, base_spans string, spans string")
