"""Personal data: base patterns, and a semi-Markov conditional random field that adds spans.

The base patterns (email, ip, card, phone) are found leftmost and without overlaps per
kind. The field then reads the neighbourhood of every remaining digit run or spelled-out
address. It scores whole candidate segments (digit counts, group shapes, checksum, octet
ranges, cue words before, what touches the ends) and a dynamic programme over
segments of at most ``LONGEST`` tokens chooses boundaries and kinds jointly. It is trained
here, on texts made by a fixed rule; no data of the corpus is needed.

Defined results: null and empty texts have no spans; very long texts are read whole;
spans are in code points with an exclusive end; added spans never overlap base ones.
Repeated rows give repeated results; extra columns are ignored.
"""

from __future__ import annotations

import bisect
import functools
import hashlib
import math
import random
import re
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from plumbline.llm.common import column, lean, text_steps

KINDS = ("email", "ip", "card", "phone")
#: Tokens that a segment holds at most.
LONGEST = 24

_LOCAL = frozenset("ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789._%+-")
_DOMAIN = re.compile(r"[A-Za-z0-9-]+(?:\.[A-Za-z0-9-]+)+")
# A match of these can only start where a digit run starts, which the lookbehind says at once.
_IP = re.compile(r"(?<![0-9])[0-9]++(?:\.[0-9]++){3}")
_CARD = re.compile(r"(?<![0-9])[0-9](?:[ -]?[0-9])++")
_PHONE = re.compile(r"\+[0-9][ ().0-9-]+[0-9]")
_DIGIT = re.compile(r"[0-9]+")


def luhn(digits: str) -> bool:
    total = 0
    for k, c in enumerate(reversed(digits)):
        d = ord(c) - 48
        total += d if k % 2 == 0 else d * 2 - 9 * (d > 4)
    return total % 10 == 0


def _digits(s: str) -> str:
    return "".join(c for c in s if "0" <= c <= "9")


def base_spans(text: str) -> dict[str, list[tuple[int, int]]]:
    """Spans of the base patterns by kind."""
    out: dict[str, list[tuple[int, int]]] = {k: [] for k in KINDS}
    end, at = 0, text.find("@")
    while at >= 0:
        start = at
        while start > end and text[start - 1] in _LOCAL:
            start -= 1
        if start < at and (m := _DOMAIN.match(text, at + 1)):
            end = m.end()
            out["email"].append((start, end))
        at = text.find("@", max(at + 1, end))
    if not _DIGIT.search(text):
        return out
    out["ip"] = [m.span() for m in _IP.finditer(text) if all(len(p.lstrip("0")) <= 3 and int(p.lstrip("0") or 0) <= 255 for p in m.group().split("."))]
    for m in _CARD.finditer(text):
        d = _digits(m.group())
        if 13 <= len(d) <= 19 and luhn(d):
            out["card"].append(m.span())
    if "+" in text:
        out["phone"] = [m.span() for m in _PHONE.finditer(text) if 9 <= len(_digits(m.group())) <= 15]
    return out


# --- the field ---------------------------------------------------------------------------------------

_TOKEN = re.compile(r"[0-9]+|[^\W\d_]+|\s+|.", re.S)
_AT = {"@", "at", "AT", "arroba", "chez"}
_DOT = {".", "dot", "DOT", "punto", "punkt", "point"}
# Words that announce a kind.
_CUES = {
    "email": {"mail", "email", "contact", "write", "reach"},
    "ip": {"ip", "host", "server", "address", "ping"},
    "card": {"card", "visa", "mastercard", "amex", "credit", "karte", "tarjeta", "carte"},
    "phone": {"tel", "phone", "call", "fax", "mobile", "telefon", "appelez", "llame", "cell", "whatsapp"},
}
_NUMERIC = {*" -().+/", "  "}


@dataclass(frozen=True)
class Candidate:
    first: int
    last: int  # exclusive
    kind: int
    features: tuple[str, ...]


def _shape(tokens: list[str]) -> str:
    return "-".join(str(len(t)) for t in tokens if t[0].isdigit())


def _edges(tokens: list[str], a: int, b: int) -> list[str]:
    before, after = tokens[a - 1] if a else " ", tokens[b] if b < len(tokens) else " "
    out = []
    if before[0].isalnum() or before in "_=\"'/#$€":
        out.append("touches_before")
    if after[0].isalnum() or after in "_=\"'/%":
        out.append("touches_after")
    if before in ".-,:" and a > 1 and tokens[a - 2][0].isdigit():
        out.append("number_before")
    if after in ".-,:" and b + 1 < len(tokens) and tokens[b + 1][0].isdigit():
        out.append("number_after")
    if before.isspace() and a > 1 and tokens[a - 2][0].isdigit():
        out.append("digits_before")
    if after.isspace() and b + 1 < len(tokens) and tokens[b + 1][0].isdigit():
        out.append("digits_after")
    return out


def candidates(tokens: list[str]) -> list[Candidate]:
    """Segments that could be an entity, each with its kind and whole-span features."""
    out = []
    for a in range(len(tokens)):
        head = tokens[a]
        if head[0].isspace():
            continue
        numeric = head[0] in "0123456789+("
        digits, words = 0, 0
        for b in range(a + 1, min(a + LONGEST, len(tokens)) + 1):
            t = tokens[b - 1]
            if numeric and not (t.isdigit() and t.isascii() or t in _NUMERIC):
                numeric = False
            if t.isdigit():
                digits += len(t)
            words += 1
            if t[0].isspace() and (len(t) > 2 or "\n" in t):
                break
            if numeric and digits > 19 or not numeric and words > 16:
                break
            if t[0].isspace():
                continue
            span = tokens[a:b]
            groups = [x for x in span if x.isdigit()]
            if numeric and t.isdigit() and digits >= 4:
                seps = [x for x in span if not x.isdigit()]
                cue = {w.lower() for w in tokens[max(0, a - 6) : a] if w.isalpha()}
                common = _edges(tokens, a, b)
                same = len(set(seps)) <= 1
                if 4 <= digits <= 12 and len(groups) == 4 and {s.strip() for s in seps} - {""} == {"."}:
                    fine = all(len(g) <= 3 and int(g) <= 255 for g in groups)
                    out.append(Candidate(a, b, 1, ("bias", "octets" if fine else "not_octets", "spaced" if " " in seps else "tight", *common, *(["cue"] if cue & _CUES["ip"] else []))))
                if 12 <= digits <= 19 and "+" not in seps and "(" not in seps:
                    d = "".join(groups)
                    out.append(Candidate(a, b, 2, ("bias", "luhn" if luhn(d) else "no_luhn", f"groups_{min(len(groups), 6)}", "usual_shape" if _shape(span) in ("4-4-4-4", "16", "4-6-5", "15") else "other_shape", "same_sep" if same else "mixed_sep", *common, *(["cue"] if cue & _CUES["card"] else []))))
                if 7 <= digits <= 15:
                    balanced = seps.count("(") == seps.count(")")
                    usual = _shape(span) in ("3-3-4", "1-3-3-4", "3-4", "2-2-2-2-2", "2-3-4", "2-4-4", "2-3-3-3", "3-3-3", "3-2-2-2")
                    out.append(Candidate(a, b, 3, ("bias", f"digits_{digits}", f"groups_{min(len(groups), 6)}", "usual_shape" if usual else "other_shape", "balanced" if balanced else "unbalanced", "plus" if head == "+" else "no_plus", "paren" if "(" in seps else "no_paren", "luhn" if luhn("".join(groups)) and digits > 12 else "short", *common, *(["cue"] if cue & _CUES["phone"] else []))))
            elif not numeric and t.isalpha() and words >= 5 and head.isalnum():
                marks = [k for k, x in enumerate(span) if x in _AT]
                dots = [k for k, x in enumerate(span) if x in _DOT]
                if len(marks) == 1 and dots and dots[-1] > marks[0] and 0 < marks[0] and span[-1].isalpha() and 2 <= len(span[-1]) <= 6:
                    bracket = any(x in "([{" for x in span)
                    spelled = span[marks[0]] != "@"
                    gaps = sum(x.isspace() for x in span)
                    local = [x for x in span[: marks[0]] if not x.isspace() and x not in _DOT and x not in "([{"]
                    joints = sum(x in _DOT for x in span[: marks[0]])
                    whole = "plain_local" if len(local) == 1 else "joined_local" if joints and len(local) == joints + 1 else "loose_local" if joints else "many_locals"
                    joint_before = a > 2 and tokens[a - 2] in _DOT and tokens[a - 1].isspace() and tokens[a - 3].isspace()
                    out.append(Candidate(a, b, 0, ("bias", "spelled_at" if spelled else "sign_at", "spelled_dot" if span[dots[-1]] != "." else "sign_dot", whole, *(["joint_before"] if joint_before else []), "bracket" if bracket else "no_bracket", f"gaps_{min(gaps, 6)}", "known_end" if span[-1].lower() in ("com", "org", "net", "edu", "de", "fr", "es", "io") else "other_end", *_edges(tokens, a, b), *(["cue"] if {w.lower() for w in tokens[max(0, a - 6) : a]} & _CUES["email"] else []))))
    return out


class SemiMarkovField:
    """Linear scores of whole segments; text outside segments scores 0 a token."""

    def __init__(self) -> None:
        self.weights: dict[tuple[int, str], float] = {}

    def score(self, c: Candidate) -> float:
        w = self.weights
        return sum(w.get((c.kind, f), 0.0) for f in c.features)

    def best(self, tokens: list[str]) -> list[Candidate]:
        """Viterbi over segmentations."""
        found = candidates(tokens)
        if not found:
            return []
        ends: dict[int, list[tuple[float, Candidate]]] = {}
        for c in found:
            if (s := self.score(c)) > 0:
                ends.setdefault(c.last, []).append((s, c))
        value, back = [0.0] * (len(tokens) + 1), [None] * (len(tokens) + 1)
        for i in range(1, len(tokens) + 1):
            value[i] = value[i - 1]
            for s, c in ends.get(i, ()):
                if value[c.first] + s > value[i]:
                    value[i], back[i] = value[c.first] + s, c
        out, i = [], len(tokens)
        while i > 0:
            c = back[i]
            if c is None:
                i -= 1
            else:
                out.append(c)
                i = c.first
        return out[::-1]

    def fit(self, examples: list[tuple[list[str], list[tuple[int, int, int]]]], rounds: int = 12, rate: float = 0.5, decay: float = 1e-4) -> None:
        """Stochastic gradient ascent on the conditional log-likelihood (forward-backward over segments)."""
        w, squares = self.weights, {}
        data = [(len(t), cs, {(c.first, c.last, c.kind) for c in cs} & set(gold)) for t, gold in examples if (cs := candidates(t))]
        for _ in range(rounds):
            for n, cs, gold in data:
                score = [self.score(c) for c in cs]
                into: dict[int, list[int]] = {}
                outof: dict[int, list[int]] = {}
                for k, c in enumerate(cs):
                    into.setdefault(c.last, []).append(k)
                    outof.setdefault(c.first, []).append(k)
                fwd, bwd = [0.0] * (n + 1), [0.0] * (n + 1)
                for i in range(1, n + 1):
                    terms = [fwd[i - 1], *(fwd[cs[k].first] + score[k] for k in into.get(i, ()))]
                    top = max(terms)
                    fwd[i] = top + math.log(sum(math.exp(t - top) for t in terms))
                for i in range(n - 1, -1, -1):
                    terms = [bwd[i + 1], *(bwd[cs[k].last] + score[k] for k in outof.get(i, ()))]
                    top = max(terms)
                    bwd[i] = top + math.log(sum(math.exp(t - top) for t in terms))
                step: dict[tuple[int, str], float] = {}
                for k, c in enumerate(cs):
                    g = ((c.first, c.last, c.kind) in gold) - math.exp(min(0.0, fwd[c.first] + score[k] + bwd[c.last] - fwd[n]))
                    if abs(g) > 1e-4:
                        for f in c.features:
                            step[c.kind, f] = step.get((c.kind, f), 0.0) + g
                for key, g in step.items():
                    squares[key] = squares.get(key, 1.0) + g * g
                    w[key] = w.get(key, 0.0) * (1 - decay) + rate * g / math.sqrt(squares[key])


def tokens_of(text: str) -> list[str]:
    return _TOKEN.findall(text)


def made_examples(count: int = 360, seed: int = 11) -> list[tuple[list[str], list[tuple[int, int, int]]]]:
    """Training texts by a fixed rule: filler words around entities and around numbers that are none."""
    r = random.Random(seed)
    number = lambda n: "".join(r.choice("0123456789") for _ in range(n))
    word = lambda: "".join(r.choice(("an", "er", "ti", "on", "sch", "le", "que", "os", "th", "en")) for _ in range(r.randint(1, 4)))

    def card() -> str:
        d = r.choice("3456") + number(14)
        d += next(c for c in "0123456789" if luhn(d + c))
        sep = r.choice((".", " ", "-", "/", "  ", ""))
        return sep.join(d[i : i + 4] for i in range(0, 16, 4))

    def phone() -> str:
        a, b, c = number(3), number(3), number(4)
        return r.choice((f"({a}) {b}-{c}", f"+1 ({a}) {b}-{c}", f"{a}-{b}-{c}", f"{a}.{b}.{c}", f"{a} {b} {c}", f"0{number(1)} {number(2)} {number(2)} {number(2)} {number(2)}", f"1-{a}-{b}-{c}", f"({a}){b}-{c}"))

    def ip() -> str:
        o = [str(r.randint(1, 254)) for _ in range(4)]
        return r.choice((" . ", ". ", " .")).join(o)

    def email() -> str:
        name, host, end = word() + r.choice(("", number(2))), word(), r.choice(("com", "org", "net", "de"))
        at, dot = r.choice(((" at ", " dot "), (" (at) ", " (dot) "), ("[at]", "[dot]"), (" @ ", " . "), (" [at] ", " [dot] "), (" AT ", " DOT "), (" [at] ", "."), (" at ", "."), ("@", "[dot]"), (" chez ", " point "), (" at ", " punkt "), (" arroba ", " punto ")))
        if r.random() < 0.3 and dot.strip() != ".":
            name = f"{word()}{dot if dot[0] == ' ' else ' dot '}{name}"
        return f"{name}{at}{host}{dot}{end}"

    def other() -> str:
        hexed = "".join(r.choice("0123456789abcdef") for _ in range(r.choice((18, 32, 40))))
        return r.choice((
            f"version {number(1)}.{number(1)}", f"{r.randint(1, 28)}.{r.randint(1, 12)}.{r.randint(1950, 2029)}", f"20{number(2)}-0{r.randint(1, 9)}-{r.randint(10, 28)}",
            f"$ {number(3)},{number(3)}.{number(2)}", f"password={hexed}", f'token = "{hexed}"', f"AKIA{number(3)}Q{number(2)}", f"{number(4)}", f"page {number(3)}",
            f"#{number(6)}", f"{number(5)}/{number(4)}", f"{number(1)},{number(3)},{number(3)}", f"{number(9)}", f"id {number(12)}", f"{number(1)}.{number(2)}.{number(1)}.{number(4)}", f"CC BY-NC {number(1)}.0",
            f"at {word()} dot", f"{number(2)}:{number(2)}:{number(2)}", f"order {number(8)}-{number(6)}", f"{number(16)}", f"1{number(3)}-1{number(3)}", f"{number(2)} {number(2)} {number(2)}",
        ))

    makers = {0: email, 1: ip, 2: card, 3: phone}
    out = []
    for k in range(count):
        text, gold = "", []
        for _ in range(r.randint(1, 2)):
            text += " ".join(word() for _ in range(r.randint(0 if text else 1, 4))) + r.choice((" ", " ", ", ", ". "))
            if r.random() < 0.55:
                kind = r.randrange(4)
                if r.random() < 0.4:
                    text += r.choice(sorted(_CUES[KINDS[kind]])) + r.choice((" ", ": "))
                entity = makers[kind]()
                gold.append((len(tokens_of(text)), len(tokens_of(text)) + len(tokens_of(entity)), kind))
                text += entity
            else:
                text += other()
            text += r.choice((" ", ". ", ", "))
        text += word()
        out.append((tokens_of(text), gold))
    return out


@functools.cache
def trained_field() -> SemiMarkovField:
    """The field fitted to the made examples: the same weights everywhere."""
    field = SemiMarkovField()
    field.fit(made_examples())
    return field


def _one_of(words: set[str]) -> str:
    """A pattern of one whole token out of ``words``."""
    return "(?:" + "|".join(rf"(?<![^\W\d_]){w}(?![^\W\d_])" if w.isalpha() else re.escape(w) for w in sorted(words)) + ")"


#: Each token of _AT as a pattern that begins with its letters, which is what makes the search fast.
_AT_TOKENS = [re.compile(rf"{w}(?<![^\W\d_]{w})(?![^\W\d_])" if w.isalpha() else re.escape(w)) for w in sorted(_AT)]
#: After it, a token of _DOT at most as many tokens later as a candidate holds.
_DOT_NEXT = re.compile(rf"(?:[^\W\d_]++|[0-9]++|[^\S\n]{{1,2}}+|[^\w\s]|_){{1,14}}?{_one_of(_DOT)}")
_REACH = 60


def anchors(text: str) -> list[tuple[int, int]]:
    """Where the field has to read, in order: every number, and every spelled-out address from its "at" to its first "dot"."""
    out = [m.span() for m in _DIGIT.finditer(text)]
    for pattern in _AT_TOKENS:
        for m in pattern.finditer(text):
            if dot := _DOT_NEXT.match(text, m.end()):
                out.append((m.start(), dot.end()))
    return sorted(out)


def added_spans(text: str, base: dict[str, list[tuple[int, int]]], field: SemiMarkovField) -> list[tuple[str, int, int]]:
    """Spans that the field finds outside the base ones, in order and without overlaps; the work grows with the text."""
    free = _gaps(sorted(s for spans in base.values() for s in spans), len(text))
    ends = [e for _, e in free]
    windows: list[list[int]] = []
    for a, b in anchors(text):
        k = bisect.bisect_right(ends, a)
        if k == len(free) or b <= free[k][0]:  # inside a base span
            continue
        if windows and a - _REACH <= windows[-1][1]:
            windows[-1][1] = max(windows[-1][1], min(len(text), b + _REACH))
        else:
            windows.append([max(0, a - _REACH), min(len(text), b + _REACH)])
    out: list[tuple[str, int, int]] = []
    for a, b in windows:
        # base spans cut a window; the field reads the pieces between them
        k = bisect.bisect_right(ends, a)
        while k < len(free) and free[k][0] < b:
            s, e = free[k]
            for kind, x, y in _read(text, max(a, s), min(b, e), field):
                if x >= s and y <= e and (not out or x >= out[-1][2]):
                    out.append((kind, x, y))
            k += 1
    return out


def _gaps(spans: list[tuple[int, int]], size: int) -> list[tuple[int, int]]:
    """What sorted ``spans`` leave of ``size`` places."""
    out, at = [], 0
    for a, b in spans:
        if a > at:
            out.append((at, a))
        at = max(at, b)
    return [*out, (at, size)] if at < size else out


def _read(text: str, a: int, b: int, field: SemiMarkovField) -> list[tuple[str, int, int]]:
    # whole tokens only: a window never cuts through a word or number
    if a >= b:
        return []
    while a > 0 and not text[a - 1].isspace() and not text[a].isspace() and b - a < 400:
        a -= 1
    tokens = tokens_of(text[a:b])
    at = [a]
    for t in tokens:
        at.append(at[-1] + len(t))
    return [(KINDS[c.kind], at[c.first], at[c.last]) for c in field.best(tokens)]


def spans_text(spans: list[tuple[str, int, int]]) -> str:
    return ",".join(f"{k}:{a}:{b}" for k, a, b in sorted(spans, key=lambda s: (KINDS.index(s[0]), s[1], s[2])))


def found(text: str, field: SemiMarkovField) -> tuple[dict[str, list[tuple[int, int]]], list[tuple[str, int, int]]]:
    base = base_spans(text)
    return base, added_spans(text, base, field)


def personal_data(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", mask: bool = False) -> DataFrame:
    """Base counts and all spans of each whole text.

    Returns ``doc_id``, ``n_<kind>`` of the base patterns, ``base_sha256``, ``spans`` and, with
    ``mask``, ``masked``: the text with every span replaced by its kind in angle brackets.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        lean()
        field = trained_field()
        for batch in batches:
            for step in text_steps(batch, "text"):
                rows: dict[str, list] = {c: [] for c in (*(f"n_{k}" for k in KINDS), "base_sha256", "spans", *(["masked"] if mask else []))}
                for text in column(step, "text").to_pylist():
                    base, extra = found(text or "", field)
                    flat = [(k, a, b) for k in KINDS for a, b in base[k]]
                    for k in KINDS:
                        rows[f"n_{k}"].append(len(base[k]))
                    rows["base_sha256"].append(hashlib.sha256(",".join(f"{k}:{a}:{b}" for k, a, b in flat).encode()).hexdigest())
                    rows["spans"].append(spans_text(flat + extra))
                    if mask:
                        rows["masked"].append(masked(text, flat + extra))
                arrays = [pa.array(v, pa.int64() if c.startswith("n_") else pa.string()) for c, v in rows.items()]
                yield pa.RecordBatch.from_arrays([column(step, "doc_id"), *arrays], names=["doc_id", *rows])

    schema = f"doc_id {dict(docs.dtypes)[id_col]}, n_email long, n_ip long, n_card long, n_phone long, base_sha256 string, spans string" + ", masked string" * mask
    return docs.select(F.col(id_col).alias("doc_id"), F.col(text_col).alias("text")).mapInArrow(run, schema)


def masked(text: str | None, spans: list[tuple[str, int, int]]) -> str | None:
    """``text`` with its spans replaced; of overlapping spans the union is replaced once, by the first kind."""
    if text is None or not spans:
        return text
    out, end = [], 0
    for kind, a, b in sorted(spans, key=lambda s: (s[1], -s[2])):
        if a >= end:
            out += [text[end:a], f"<{kind}>"]
        end = max(end, b)
    return "".join([*out, text[end:]])


def masked_documents(docs: DataFrame) -> DataFrame:
    """``docs`` with every span in ``text`` replaced by its kind and ``n_chars``, if there, counted anew."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        lean()
        field = trained_field()
        for batch in batches:
            for step in text_steps(batch, "text"):
                texts = []
                for text in column(step, "text").to_pylist():
                    base, extra = found(text or "", field)
                    texts.append(masked(text, [(k, a, b) for k in KINDS for a, b in base[k]] + extra))
                at = step.schema.get_field_index("text")
                yield step.set_column(at, step.schema.field(at).with_type(pa.string()), pa.array(texts, pa.string()))

    out = docs.mapInArrow(run, docs.schema)
    return out.withColumn("n_chars", F.length("text").cast(dict(docs.dtypes)["n_chars"])) if "n_chars" in docs.columns else out
