"""Operator 8, personal data: a linear-chain conditional random field over word shapes, beside exact patterns.

The patterns give the base spans. The field is trained on the driver from a small labelled table (the
sentences below, filled with made-up values), and finds what the patterns miss: addresses written
with (at) and dot, telephone numbers without a plus, numbers grouped by other marks. Its sequences are the
neighbourhoods of words that hold a digit, an at sign, "at" or "dot" in any case (MARGIN words on each side,
overlapping ones joined): a span without one of these is not kept. Sequences of a batch are decoded together
by Viterbi in numpy. A found span is kept if it has the digits or parts of its kind and meets no base span.

Defined results: null or empty text: no spans, the digest of ''; offsets are code points, ends exclusive;
ties in decoding take the first label; repeated rows give the same; extra columns do not matter.
"""

from __future__ import annotations

import hashlib
import re
import zlib
from collections.abc import Iterator
from functools import lru_cache

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .shared import small_batches, table

KINDS = ("email", "ip", "card", "phone")
# The base patterns.
EMAIL = re.compile(r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+")
IP = re.compile(r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)")
#: Parts of these that a text is searched for once: runs before an at sign, names after it, digits with dots.
LOCAL, DOMAIN, DOTTED = re.compile(r"[A-Za-z0-9._%+-]++"), re.compile(r"[A-Za-z0-9-]++(?:\.[A-Za-z0-9-]++)++"), re.compile(r"[0-9]++(?:\.[0-9]++)*+")
CARD = re.compile(r"[0-9]([\x20-]?[0-9])+")
PHONE = re.compile(r"\+[0-9][\x20().0-9-]+[0-9]")
DIGITS = re.compile(r"[0-9]")

MARGIN = 3
# What a plausible span cannot be without; MARK is what stands for @ and a dot.
TRIGGER = re.compile(r"[0-9@]|\b(?:dot|at)\b", re.I)
MARK = re.compile(r"\b(?:at|dot)\b", re.I)
LABELS = ("O", *(f"{p}-{k}" for k in KINDS for p in "BI"))
WIDTH = 1 << 12  # hashed features

OFFSETS = (-2, -1, 0, 1, 2)  # the words whose features a place has
# The labelled table. Every form of a value stands in every sentence of its kind and of ANY, {v} for the value; PLAIN has none to find:
# {number}, {date}, {version}, {key} stand for what is no personal data.
ANY = """
Please write to {v} before noon.
contact: {v}, or ask at the desk
his was {v} and hers {v}
thonea {v} ereng the anst
{v}
We have {v} on file, they said.
see {v} for more
on {date} we noted {v} there
the {number} of {v} are gone
({v})
it is {v}. Then we left
new one {v} (see below) as of {date}
ask for {v} when it is late
{v}, now and then
"""
SENTENCES = {
    "email": "mail {v} today\ne-mail: {v}\nsend it to {v} at once",
    "phone": "Call {v} for help.\ntel. {v} or {v}, any day\nthe number {v} is ours\nphone: {v}\nring me at {v} at night",
    "card": "paid with card {v} on {date}\n{v} was charged twice\ncard no. {v}, valid until {date}",
    "ip": "logged in from {v} at night\nhost {v} refused the packet",
}
PLAIN = """
on {date} we sold {number} boxes
version {version} came out, and then {version}
Licensed under the licence, Version {version}
chapter {number}, page {number} and line {number}
in {number} there were {number} of them
look at the dot on the map
we met at noon at the {number} gate
a dot and a line at one end
stay at home or dot the line
at {number} dot {number} they stood
the total of {number} items cost {number}
{number} {number} {number} {number}
{number}-{number} and {number}/{number}
{number}, {number}, {number}
password={key} was set
token = "{key}" in the file
key {key} expires on {date}
order {number} of {date} shipped
born in {number} at home
a ratio of {version} to {number}
thin the and of er at thes an
see section {version} on page {number}
from {date} to {date}
a thing (or two) at the end (of it), and so on
"""


def luhn(digits: str) -> bool:
    total = 0
    for i, c in enumerate(reversed(digits)):
        x = int(c) * (1 + i % 2)
        total += x - 9 if x > 9 else x
    return total % 10 == 0


def fits(kind: str, text: str) -> bool:
    """The conditions on a match of the base patterns."""
    digits = "".join(DIGITS.findall(text))
    if kind == "ip":
        return all(len(p.lstrip("0")) <= 3 and int(p.lstrip("0") or 0) <= 255 for p in text.split("."))
    if kind == "card":
        return 13 <= len(digits) <= 19 and luhn(digits)
    return 9 <= len(digits) <= 15 if kind == "phone" else True


def email_spans(text: str) -> Iterator[tuple[int, int]]:
    """The matches of EMAIL, each run of characters read once (a long run without an at sign is no burden)."""
    done = 0
    for m in LOCAL.finditer(text):
        if text.startswith("@", m.end()) and m.end() > done and (d := DOMAIN.match(text, m.end() + 1)):
            yield max(m.start(), done), d.end()
            done = d.end()


def ip_spans(text: str) -> Iterator[tuple[int, int]]:
    """The matches of IP: of a chain of numbers with dots, four at a time."""
    for m in DOTTED.finditer(text):
        if m.group().count(".") >= 3:
            at, parts = m.start(), m.group().split(".")
            for k in range(0, len(parts), 4):
                end = at + sum(map(len, parts[k : k + 4])) + len(parts[k : k + 4]) - 1
                if len(parts) - k >= 4:
                    yield at, end
                at = end + 1


def base_spans(text: str) -> list[tuple[int, int, int]]:
    """(kind, start, end) by kind, then start. A text without an at sign or a plus is not searched for what needs one."""
    out = []
    if "@" in text:
        out += [(0, a, b) for a, b in email_spans(text)]
    out += [(1, a, b) for a, b in ip_spans(text) if fits("ip", text[a:b])]
    for k, pattern, needs in ((2, CARD, ""), (3, PHONE, "+")):
        if needs in text:
            out += [(k, m.start(), m.end()) for m in pattern.finditer(text) if fits(KINDS[k], m.group())]
    return out


# The field

def shape(word: str) -> str:
    """Letters by case, digits, other marks; long runs shortened, digit runs kept up to 4."""
    s = re.sub(r"[^\W\d_]", lambda m: "A" if m.group().isupper() else "a", word)
    s = re.sub(r"\d", "9", s)
    return re.sub(r"9{5,}", "9+", re.sub(r"([aA])\1+", r"\1", s))[:40]


#: Words that are features themselves: those of the sentences, and marks and endings of addresses; not those of values.
KNOWN = frozenset(w.lower().strip(".,:;()") for w in " ".join([ANY, *SENTENCES.values(), PLAIN, "com org net"]).split() if "{" not in w)


BRACKETS = str.maketrans("[{<]}>", "((()))")  # all brackets are alike


def features(word: str) -> list[int]:
    word = MARK.sub(lambda m: m.group().lower(), word).translate(BRACKETS)
    digits = len(DIGITS.findall(word))
    s, core = shape(word), word.lower().strip(".,:;()[]{}<>\"'")
    marks = "".join(sorted(set(re.sub(r"[\w\s]", "", word.strip(".,:;\"'")))))[:6]
    names = [f"s{s}", f"c{shape(word.strip('.,:;'))}", f"d{min(digits, 20)}", f"g{min(digits // 4, 5)}", f"f{s[:2]}", f"l{s[-2:]}", f"@{'@' in word}", f"m{marks}", f"z{word.strip('(+').startswith('0') and digits}", f"a{not digits}{core.isalnum()}"]
    if core in KNOWN:
        names.append(f"w{core}")
    return [zlib.crc32(x.encode("utf-8", "surrogatepass")) % WIDTH for x in names]


def forms(r: np.random.Generator) -> dict[str, dict[str, str]]:
    """A made-up value of every form of every kind."""
    d = lambda n: "".join(map(str, r.integers(0, 10, n)))
    name = lambda: "".join(r.choice(list("abcdefghiklmnoprstuvw"), int(r.integers(3, 10))))
    n, h = name(), f"{name()}{d(1) if r.random() < 0.3 else ''}"
    end = str(r.choice(["com", "org", "net"]))
    return {
        "email": {"dotted": f"{n}.{d(2)}@{h}.example.{end}", "plain": f"{n}@{h}.{end}", "upper": f"{n.upper()}@{h}.{end}", "(at)": f"{n} (at) {h} dot {end}", "[at]": f"{n}[at]{h}[dot]{end}", "at": f"{n} at {h} dot {end}", "[at] .": f"{n} [at] {h}.{end}"},
        "phone": {"+1": f"+1 ({d(3)}) 555-{d(4)}", "555": f"({d(3)}) 555-{d(4)}", "()": f"({d(3)}) {d(3)}-{d(4)}", "+": f"+{d(2)} {d(3)} {d(4)} {d(3)}", "-": f"{d(3)}-{d(3)}-{d(4)}", ".": f"{d(3)}.{d(3)}.{d(4)}", "+n": f"+{d(11)}", "0": f"0{d(3)} {d(3)} {d(4)}"},
        "card": {"n": d(16), " ": f"{d(4)} {d(4)} {d(4)} {d(4)}", "-": f"{d(4)}-{d(4)}-{d(4)}-{d(4)}", ".": f"{d(4)}.{d(4)}.{d(4)}.{d(4)}", "465": f"{d(4)} {d(6)} {d(5)}"},
        "ip": {".": ".".join(str(x) for x in r.integers(1, 256, 4))},
    }


def plain_value(kind: str, r: np.random.Generator) -> str:
    d = lambda n: "".join(map(str, r.integers(0, 10, n)))
    name = lambda: "".join(r.choice(list("abeinorst"), int(r.integers(3, 9))))
    pick = lambda *x: x[int(r.integers(len(x)))]
    first = str(r.integers(1, 10))
    if kind == "date":
        return pick(f"20{d(2)}-0{r.integers(1, 10)}-1{d(1)}", f"1{d(1)}.0{r.integers(1, 10)}.20{d(2)}", f"{r.integers(1, 13)}/{r.integers(1, 29)}/19{d(2)}")
    if kind == "version":
        return pick(f"{d(1)}.{d(1)}", f"{d(1)}.{d(1)}.", f"{d(1)}.{d(2)}.{d(1)}", f"{d(2)}.{d(3)}")
    if kind == "key":
        return pick(name() + d(3) + name() + d(8) + name(), "AK" + name().upper() + d(1) + name().upper(), d(7) + "a" + d(6) + "be" + d(5))
    return pick(first, first + d(1), first + d(2), first + d(3), first + d(5), f"{first}{d(2)},{d(3)}", f"{first}{d(1)}%", f"{first}.{d(2)}", first + d(8))


def training_table(copies: int = 3, seed: int = 7) -> list[tuple[list[str], list[int]]]:
    """Words and labels: every form in every sentence of its kind, and the plain lines, `copies` times.

    A word of a sentence is a made-up one half of the time, so that values are told by themselves and not by the sentence alone.
    """
    r = np.random.default_rng(seed)
    work: list[tuple[str, str, str]] = []
    for _ in range(copies):
        for kind, some in forms(r).items():
            work += [(line, kind, form) for form in some for line in [*ANY.strip().split("\n"), *SENTENCES[kind].split("\n")]]
        work += [(line, "", "") for line in PLAIN.strip().split("\n") for _ in range(12)]
    out = []
    for line, kind, form in work:
        words, labels, glued = [], [], False
        for piece in re.split(r"(\{\w+\})", line):
            what = piece[1:-1] if piece.startswith("{") else ""
            if what:
                text = forms(r)[kind][form] if what == "v" else plain_value(what, r)
            else:
                swap = lambda m: m.group() if m.group().lower() in ("at", "dot") or r.random() < 0.5 else "".join(r.choice(list("aeinorstdlh"), len(m.group())))
                text = re.sub(r"[^\W\d_]{2,}", swap, piece)
            for i, w in enumerate(text.split()):
                if glued and i == 0 and not text[0].isspace():
                    words[-1] += w
                    if what == "v" and not labels[-1]:
                        labels[-1] = LABELS.index(f"B-{kind}")  # behind an opening bracket
                else:
                    words.append(w)
                    labels.append(LABELS.index(f"{'I' if i else 'B'}-{kind}") if what == "v" else 0)
            if text:
                glued = not text[-1].isspace()
        out.append((words, labels))
    return out


class Field:
    """weights of (offset, feature, label), and of label pairs."""

    def __init__(self):
        self.emit = np.zeros((len(OFFSETS) * WIDTH, len(LABELS)))
        self.move = np.zeros((len(LABELS), len(LABELS)))

    @staticmethod
    def indices(words: list[str], known: dict[str, np.ndarray]) -> list[np.ndarray]:
        own = []
        for w in words:
            if w not in known:
                if len(known) > 200_000:
                    known.clear()
                known[w] = np.array(features(w))
            own.append(known[w])
        return [np.concatenate([own[i + o] + k * WIDTH for k, o in enumerate(OFFSETS) if 0 <= i + o < len(own)]) for i in range(len(own))]

    def emissions(self, rows: list[list[np.ndarray]]) -> tuple[np.ndarray, np.ndarray]:
        """Padded (sequences, places, labels) scores, and lengths."""
        sizes = np.array([len(r) for r in rows])
        flat = [x for r in rows for x in r]
        counts = np.array([len(x) for x in flat])
        each = np.add.reduceat(self.emit[np.concatenate(flat)], np.cumsum(counts) - counts, axis=0)
        out = np.zeros((len(rows), sizes.max(), len(LABELS)))
        seq = np.repeat(np.arange(len(rows)), sizes)
        out[seq, np.arange(len(flat)) - np.repeat(np.cumsum(sizes) - sizes, sizes)] = each
        return out, sizes

    def viterbi(self, rows: list[list[np.ndarray]]) -> list[np.ndarray]:
        e, sizes = self.emissions(rows)
        best, back = e[:, 0], np.zeros(e.shape, np.int8)
        ends = [best]
        for t in range(1, e.shape[1]):
            ways = best[:, :, None] + self.move
            back[:, t] = ways.argmax(axis=1)
            best = ways.max(axis=1) + e[:, t]
            ends.append(best)
        out = []
        for i, n in enumerate(sizes):
            y = np.zeros(n, np.int64)
            y[-1] = ends[n - 1][i].argmax()
            for t in range(n - 1, 0, -1):
                y[t - 1] = back[i, t, y[t]]
            out.append(y)
        return out

    def expected(self, e: np.ndarray, sizes: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Of emissions: each place's label probabilities, and the expected counts of label pairs, by forward and backward sums."""
        n, t_max = len(LABELS), e.shape[1]
        alive = np.arange(t_max)[None, :] < sizes[:, None]
        fwd, bwd = np.zeros_like(e), np.zeros_like(e)
        m = np.exp(self.move)
        x = np.exp(e - e.max(axis=2, keepdims=True))
        fwd[:, 0] = x[:, 0] / x[:, 0].sum(axis=1, keepdims=True)
        for t in range(1, t_max):
            f = (fwd[:, t - 1] @ m) * x[:, t]
            fwd[:, t] = f / f.sum(axis=1, keepdims=True)
        bwd[:, -1] = 1
        for t in range(t_max - 2, -1, -1):
            b = (x[:, t + 1] * bwd[:, t + 1]) @ m.T
            b /= b.sum(axis=1, keepdims=True)
            bwd[:, t] = np.where(alive[:, t + 1 : t + 2], b, 1.0)
        p = fwd * bwd
        p /= p.sum(axis=2, keepdims=True)
        pair = np.zeros((n, n))
        for t in range(1, t_max):
            on = alive[:, t]
            q = fwd[on, t - 1][:, :, None] * m[None] * (x[on, t] * bwd[on, t])[:, None, :]
            pair += (q / q.sum(axis=(1, 2), keepdims=True)).sum(axis=0)
        return p, pair

    def train(self, table: list[tuple[list[str], list[int]]], rounds: int = 60, rate: float = 0.3, ridge: float = 0.002) -> Field:
        """Gradient steps (with per-weight scaling) on the log-likelihood."""
        known: dict[str, np.ndarray] = {}
        rows = [self.indices(w, known) for w, _ in table]
        sizes = np.array([len(r) for r in rows])
        flat = [x for r in rows for x in r]
        of = np.repeat(np.arange(len(flat)), [len(x) for x in flat])
        idx = np.concatenate(flat)
        gold = np.concatenate([np.array(y) for _, y in table])
        seq = np.repeat(np.arange(len(rows)), sizes)
        place = np.arange(len(flat)) - np.repeat(np.cumsum(sizes) - sizes, sizes)
        n = len(LABELS)
        gold_move = np.zeros((n, n))
        inner = place > 0
        np.add.at(gold_move, (gold[np.flatnonzero(inner) - 1], gold[inner]), 1)
        g2e, g2m = np.full_like(self.emit, 1e-6), np.full_like(self.move, 1e-6)
        for _ in range(rounds):
            e, _ = self.emissions(rows)
            p, pair = self.expected(e, sizes)
            delta = -p[seq, place]
            delta[np.arange(len(gold)), gold] += 1
            ge = -ridge * self.emit
            np.add.at(ge, idx, delta[of])
            gm = gold_move - pair - ridge * self.move
            g2e += ge**2
            g2m += gm**2
            self.emit += rate * ge / np.sqrt(g2e)
            self.move += rate * gm / np.sqrt(g2m)
        return self


def neighbourhoods(text: str) -> Iterator[list[tuple[str, int]]]:
    """The sequences of a text: words with their starts."""
    def left(at: int) -> int:
        for _ in range(MARGIN + 1):
            while at > 0 and text[at - 1].isspace():
                at -= 1
            while at > 0 and not text[at - 1].isspace():
                at -= 1
        return at

    def right(at: int) -> int:
        while at < len(text) and not text[at].isspace():
            at += 1
        for _ in range(MARGIN):
            while at < len(text) and text[at].isspace():
                at += 1
            while at < len(text) and not text[at].isspace():
                at += 1
        return at

    low = high = -1
    for m in TRIGGER.finditer(text):
        if m.start() < safe if high >= 0 else False:
            continue
        a, b = left(m.start()), right(m.start())
        word_end = m.start()
        while word_end < len(text) and not text[word_end].isspace():
            word_end += 1
        safe = word_end  # further triggers in this word add nothing
        if high >= 0 and a <= high:
            high = max(high, b)
        else:
            if high >= 0:
                yield [(w.group(), w.start() + low) for w in re.finditer(r"\S+", text[low:high])]
            low, high = a, b
    if high >= 0:
        yield [(w.group(), w.start() + low) for w in re.finditer(r"\S+", text[low:high])]


def plausible(kind: int, text: str) -> bool:
    digits = "".join(DIGITS.findall(text))
    if KINDS[kind] == "email":
        return bool(re.search(r"\S\s*(@|[\[(]at[\])]|\bat\b)\s*\S", text, re.I) and re.search(r"\.|\bdot\b", text, re.I)) and len(text) < 120
    if KINDS[kind] == "ip":
        return bool(re.fullmatch(r"[0-9]+(\.[0-9]+){3}", text)) and fits("ip", text)
    if KINDS[kind] == "card":
        return 13 <= len(digits) <= 19 and luhn(digits) and not re.search(r"[^\W\d_]", text)
    return 10 <= len(digits) <= 15 and bool(re.fullmatch(r"[+(]?[0-9][0-9().\x20/-]*[0-9]", text)) and bool(re.search(r"[().\x20/-]", text)) and not re.fullmatch(r"[0-9]+(\.[0-9]+){3}", text)


def decoded(field: Field, texts: list[str], known: dict[str, np.ndarray]) -> list[list[tuple[int, int, int]]]:
    """Per text: the spans that the field finds."""
    out: list[list[tuple[int, int, int]]] = [[] for _ in texts]
    work = [(i, s) for i, t in enumerate(texts) if t for s in neighbourhoods(t)]
    work.sort(key=lambda x: len(x[1]))  # sequences of like length are padded together
    at = 0
    while at < len(work):
        some, size = [], 0
        while at < len(work) and (not some or size + len(work[at][1]) < 40_000 and len(work[at][1]) * (len(some) + 1) < 80_000):
            some.append(work[at])
            size += len(work[at][1])
            at += 1
        for (i, words), y in zip(some, field.viterbi([field.indices([w for w, _ in s], known) for _, s in some]), strict=True):
            k = 0
            while k < len(y):
                if y[k] and y[k] % 2:
                    kind, end = (y[k] - 1) // 2, k + 1
                    while end < len(y) and y[end] == y[k] + 1:
                        end += 1
                    low, high = words[k][1], words[end - 1][1] + len(words[end - 1][0])
                    raw = texts[i][low:high]
                    low += len(raw) - len(raw.lstrip("\"'<[{,;:"))
                    high -= len(raw) - len(raw.rstrip("\"'>]},;:.!?"))
                    if low < high and plausible(kind, texts[i][low:high]):
                        out[i].append((int(kind), low, high))
                    k = end
                else:
                    k += 1
    return out


def all_spans(field: Field, texts: list[str], known: dict[str, np.ndarray]) -> list[tuple[list, list]]:
    """Per text: base spans, and all spans, by kind, then start."""
    out = []
    for text, more in zip(texts, decoded(field, texts, known), strict=True):
        base = base_spans(text)
        taken = sorted((s, e) for _, s, e in base)
        starts = np.array([s for s, _ in taken])
        reach = np.maximum.accumulate(np.array([e for _, e in taken])) if taken else starts
        extra = [x for x in more if not (k := int(np.searchsorted(starts, x[2]))) or reach[k - 1] <= x[1]]
        out.append((base, sorted(base + extra)))
    return out


def shown(spans: list[tuple[int, int, int]]) -> str:
    return ",".join(f"{KINDS[k]}:{s}:{e}" for k, s, e in spans)


@lru_cache(1)
def trained() -> Field:
    return Field().train(training_table())


def found(docs: DataFrame) -> DataFrame:
    """doc_id, n_email, n_ip, n_card, n_phone (base), base_sha256, spans (all)."""
    small_batches(docs.sparkSession)
    sent = docs.sparkSession.sparkContext.broadcast(trained())  # of fixed size

    def run(it):
        known: dict[str, np.ndarray] = {}
        for b in it:
            both = all_spans(sent.value, [t or "" for t in b.column("text").to_pylist()], known)
            counts = [pa.array([sum(x[0] == k for x in base) for base, _ in both], pa.int64()) for k in range(len(KINDS))]
            digests = pa.array([hashlib.sha256(shown(base).encode()).hexdigest() for base, _ in both], pa.string())
            yield pa.RecordBatch.from_arrays([b.column("doc_id"), *counts, digests, pa.array([shown(a) for _, a in both], pa.string())], ["doc_id", *(f"n_{k}" for k in KINDS), "base_sha256", "spans"])

    given = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text"))
    return given.mapInArrow(run, "doc_id long, n_email long, n_ip long, n_card long, n_phone long, base_sha256 string, spans string")


def masked(docs: DataFrame, text: str = "text") -> DataFrame:
    """docs with every span replaced by its kind in brackets; where spans meet, the first stays."""
    small_batches(docs.sparkSession)
    sent = docs.sparkSession.sparkContext.broadcast(trained())

    def run(it):
        known: dict[str, np.ndarray] = {}
        for b in it:
            texts = b.column(text).to_pylist()
            out = []
            for t, (_, spans) in zip(texts, all_spans(sent.value, [t or "" for t in texts], known), strict=True):
                parts, at = [], 0
                for k, s, e in sorted(spans, key=lambda x: (x[1], -x[2])):
                    if s >= at:
                        parts += (t[at:s], f"[{KINDS[k].upper()}]")
                        at = e
                    else:
                        at = max(at, e)
                out.append("".join((*parts, t[at:])) if spans else t)
            yield b.set_column(b.schema.get_field_index(text), text, pa.array(out, pa.string()))

    return docs.mapInArrow(run, docs.schema)


def op8_pii(spark: SparkSession, sf_dir: str) -> DataFrame:
    return found(table(spark, sf_dir, "documents"))


QUERIES = {"op8_pii": op8_pii}
