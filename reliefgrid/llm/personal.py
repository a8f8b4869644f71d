"""Personal data in texts: fixed patterns, and a linear-chain conditional random field.

The patterns find the base spans. The field reads every whole text as one sequence of
words, numbers and signs, and tags them by what they look like: kinds and lengths, their
neighbours, the number and the blank-delimited word they are part of. It adds what the
patterns miss, such as numbers without their plus sign or addresses with spelt-out signs.
Its spans are added only where no base span is. The texts of a step are read at once, in
arrays; a text takes about 250 bytes a token.

It learns on the driver from a small labelled table: the lines below, and of about
DOCUMENTS documents the first SAMPLE surroundings of digits and at signs and the first
PROSE pieces of what is between them, in hash order. These carry the tags of their base
spans, so that what merely looks similar in this corpus, and its prose, stays untagged.
"""

from __future__ import annotations

import hashlib
import re
from bisect import bisect_left
from collections.abc import Callable, Iterator
from dataclasses import dataclass
from functools import cache

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from reliefgrid.llm.arrow import steps

KINDS = ("email", "ip", "card", "phone")
#: Tags: 0 is none; kind k begins with 1 + 2 k and goes on with 2 + 2 k.
TAGS = 1 + 2 * len(KINDS)

#: The base patterns, written so that they take time in proportion to the text.
LOCAL = "ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789._%+-"
DOMAIN = re.compile(r"[A-Za-z0-9-]++(?:\.[A-Za-z0-9-]++)++")
IP = re.compile(r"[0-9](?<![0-9][0-9])[0-9]*+(?:\.[0-9]++){3}")
CARD = re.compile(r"[0-9](?:[\x20-]?[0-9])++")
PHONE = re.compile(r"\+[0-9][\x20().0-9-]+[0-9]")
DIGIT = re.compile(r"[0-9]")

#: Corpus windows that are learned from, and the code points of the longest.
SAMPLE, TAUGHT = 300, 200
#: Pieces of prose that are learned from, about as many as lines: with many more of them the lines would count too little.
PROSE = 50
#: About so many documents, chosen by hash, give these windows.
DOCUMENTS = 20_000
#: Code points around a digit or sign that a window takes in, and the longest window.
AROUND, LONGEST = 40, 4096
EPOCHS, RATE, DECAY = 60, 0.1, 2e-3
#: Tokens that are decoded at a time; a longer text is decoded alone.
PLACES = 1 << 17
#: Tokens of the parts that long texts are decoded in, and those more at their ends.
PART, RIM = 512, 64

#: Labelled lines; spans stand in brackets after their kind.
LINES = """\
write to [email anna.berg at mail.example.com] before noon
write to [email j.doe (at) example.org] or call [phone 030 5557 1234]
mail [email ann [at] host.example.net] for help
ask [email tim (at) host.example.net] about it
please tell [email lena (at) web.example.org] today
give it to [email udo [at] example.com] then
reach me: [email bob(at)example.com]
contact [email sales @ example.com] today
contact [email peter.m @example.org] now
send it to [email info at example dot com] please
her address is [email maria_7 at mail dot example dot org] and nothing else
phone [phone (243) 555-5526] after six
phone [phone 243-555-5526] after six
call [phone 555-5526] or [phone (0) 30 555 7713]
tel. [phone 0049 30 5557713] office
tel: [phone 017 5557713]
fax [phone 1-487-555-7209] only
mobile [phone 0171/5557209] is best
and that [phone (974) 555-3436] was hers
or [phone 974.555.3436] if not
the host [ip 97.51.17.173 ] is down
server [ip 10 . 0 . 0 . 12] does not answer
the address [ip 192,168,0,17] was seen
ip [ip 172.16.4.9] and port 8080
card [card 4716 3208 9361 0054] expires 09/27
credit card [card 4736.9625.7309.9581] was used
visa [card 4795_5229_3596_1213] thanks
card no [card 4736/9625/7309/9581] and code 123
on 12.03.2021 at 10:30 we met in room 204
version 2.0.1 of 3 March 1999 replaces version 1.9
Licensed under CC BY-NC 4.0 and version 3.
token = "04dbebab91ab85687d33eeaaf9ac699e1188f962" for the build
order 4736962573099580 was shipped on 2020-01-31
see pages 101-115 and 220 in volume 12
the sum of 1,250.75 and 3,000 is 4,250.75
it took 35 of 60 minutes at 12 percent
chapter 7, section 3.2.4, figure 12
article id 9807915762804491 has 16 digits
between 1914 and 1918 about 20 000 000 people
the score was 3-1 after 90 minutes
we have 3 @ 5 each and 7 of 9
follow @someone and 12 others
isbn 978-3-16-148410-0 is a book
x = 0x7f3a2b and y = 17
"""
MARK = re.compile(rf"\[({'|'.join(KINDS)}) ")

#: Words that hint at a kind, or against one.
CUES = frozenset("at dot com org net mail email e phone tel call fax mobile card credit visa ip host server address port version token id isbn page order license".split())

TOKEN = re.compile(r"[^\W\d_]+|[0-9]+|[^\s0-9]")
SIGNAL = re.compile(r"[0-9@]+|[(\[{] ?(?i:at) ?[)\]}]| (?i:dot) ")
NUMBER = re.compile(r"\+?\(?[0-9](?:[ .,_()/-]{0,2}[0-9]++)*+")
BLANKS = re.compile(r"\S+")


def luhn(digits: str) -> bool:
    """Whether the check digit of a number is right."""
    own = [ord(c) - 48 for c in reversed(digits)]
    return (sum(own[::2]) + sum(d * 2 - 9 * (d > 4) for d in own[1::2])) % 10 == 0


def _digits(text: str) -> str:
    return "".join(c for c in text if "0" <= c <= "9")


def base_spans(text: str) -> list[list[tuple[int, int]]]:
    """The base spans of each kind, as code points, ends exclusive.

    Each kind's matches are leftmost and don't overlap; those that fail their check are dropped.
    """
    emails = []
    end, at = 0, text.find("@")
    while at >= 0:
        before = text[end:at]
        start = at - (len(before) - len(before.rstrip(LOCAL)))
        if start < at and (m := DOMAIN.match(text, at + 1)):
            end = m.end()
            emails.append((start, end))
        at = text.find("@", at + 1)
    if not DIGIT.search(text):
        return [emails, [], [], []]
    ips = [m.span() for m in IP.finditer(text) if all(len(p.lstrip("0")) <= 3 and int(p.lstrip("0") or 0) <= 255 for p in m[0].split("."))]
    cards = [m.span() for m in CARD.finditer(text) if 16 <= len(d := _digits(m[0])) <= 19 and luhn(d)]
    phones = [m.span() for m in PHONE.finditer(text) if 8 <= len(_digits(m[0])) <= 15]
    return [emails, ips, cards, phones]


def listed(spans: list[list[tuple[int, int]]]) -> str:
    return ",".join(f"{k}:{a}:{b}" for k, own in zip(KINDS, spans) for a, b in own)


def windows(text: str) -> list[tuple[int, int]]:
    """The surroundings of digits and at signs, joined where they meet; long ones are cut, at white space if they have any."""
    found: list[list[int]] = []
    for m in SIGNAL.finditer(text):
        a, b = max(0, m.start() - AROUND), min(len(text), m.end() + AROUND)
        if found and a <= found[-1][1]:
            found[-1][1] = b
        else:
            found.append([a, b])
    out = []
    for a, b in found:
        while b - a > LONGEST:
            cut = max(text.rfind(" ", a + 1, a + LONGEST), text.rfind("\n", a + 1, a + LONGEST))
            cut = cut if cut > a else a + LONGEST
            out.append((a, cut))
            a = cut
        out.append((a, b))
    return out


def _some(n: int) -> str:
    """A number's class: exact up to 4, and where the lengths of numbers matter."""
    return str(n) if n <= 4 or 13 <= n <= 20 else "5" if n <= 6 else "7" if n <= 8 else "9" if n <= 12 else "many"


def _shape(token: str) -> str:
    c = token[0]
    if "0" <= c <= "9":
        return f"d{_some(len(token))}" + ("v" if len(token) <= 3 and int(token) <= 255 else "")
    if c.isalpha():
        return ("u" if token.isupper() else "t" if c.isupper() else "l") + str(min(len(token), 4))
    return c if c < "\x7f" else "?"


def tokens(window: str) -> list[tuple[int, int]]:
    return [m.span() for m in TOKEN.finditer(window)]


def features(window: str, cut: list[tuple[int, int]]) -> list[list[str]]:
    """What each token looks like: its own shape, its neighbours', and those of the number and the word that hold it."""
    inside = [""] * len(window)
    for m in BLANKS.finditer(window):
        word = m[0]
        letters, numbers = any(c.isalpha() for c in word), bool(DIGIT.search(word))
        flag = ("@" if "@" in word[1:] else "") + ("m" if letters and numbers else "") + str(min(word.count("."), 4))
        inside[m.start() : m.end()] = [flag] * len(word)
    number = [("", "")] * len(window)
    for m in NUMBER.finditer(window):
        d = _digits(m[0])
        parts = re.findall("[0-9]+", m[0])
        dotted = "i" if len(parts) == 4 and len(d) <= 12 and all(int(p) <= 255 for p in parts) else ""
        check = "c" if 13 <= len(d) <= 19 and luhn(d) else ""
        number[m.start() : m.end()] = [(_some(len(d)) + check + dotted, f"{_some(len(parts))}{m[0][0] if m[0][0] in '+(' else ''}")] * (m.end() - m.start())
    shapes = [_shape(window[a:b]) for a, b in cut]
    glued = ["+" if i and cut[i - 1][1] == a else "_" for i, (a, _) in enumerate(cut)]
    whole = [g + s for g, s in zip(glued, shapes)]
    near = lambda i: whole[i] if 0 <= i < len(whole) else "end"
    cues = [w if (w := window[a:b].lower()) in CUES else "" for a, b in cut]
    out = []
    for i, (a, _) in enumerate(cut):
        n, parts = number[a]
        hint = next((c for c in cues[max(0, i - 4) : i][::-1] if c), "")
        out.append([f"s{shapes[i]}", f"g{near(i)}", f"w{cues[i]}", f"p{near(i - 1)}", f"n{near(i + 1)}", f"P{near(i - 2)}", f"N{near(i + 2)}", f"#{n}", f"%{n}/{parts}", f"&{n}/{parts}/{shapes[i]}/{glued[i]}", f"i{inside[a]}", f"I{inside[a]}/{shapes[i]}/{near(i - 1)}", f"h{hint}", f"H{hint}/{n}"])
    return out


def _tagged(cut: list[tuple[int, int]], spans: list[list[tuple[int, int]]], at: int = 0) -> list[int]:
    """The tag of each token of a window that begins at ``at``; earlier kinds win where spans overlap."""
    tags = [0] * len(cut)
    for k, own in enumerate(spans):
        for a, b in own:
            inside = [i for i, (s, e) in enumerate(cut) if s + at < b and e + at > a]
            if inside and not any(tags[i] for i in inside):
                for i in inside:
                    tags[i] = 2 + 2 * k
                tags[inside[0]] -= 1
    return tags


def marked(line: str) -> tuple[str, list[list[tuple[int, int]]]]:
    """A labelled line's text and its spans."""
    text, spans, at = "", [[] for _ in KINDS], 0
    for m in MARK.finditer(line):
        text += line[at : m.start()]
        depth, end = 1, m.end()
        while depth:
            depth += {"[": 1, "]": -1}.get(line[end], 0)
            end += 1
        spans[KINDS.index(m[1])].append((len(text), len(text) + end - 1 - m.end()))
        text += line[m.end() : end - 1]
        at = end
    return text + line[at:], spans


@dataclass
class Field:
    """Weights of features by tag, of tags after tags, and of first tags."""

    number: dict[str, int]
    own: np.ndarray
    after: np.ndarray
    first: np.ndarray

    def rows(self, looks: list[list[str]]) -> np.ndarray:
        """Each token's weights by tag."""
        get = self.number.get
        return self.own[np.array([[get(f, 0) for f in some] for some in looks])].sum(axis=1)


def _allowed() -> tuple[np.ndarray, np.ndarray]:
    """Steps and first tags that make sense: a kind goes on only after itself."""
    after, first = np.zeros((TAGS, TAGS)), np.zeros(TAGS)
    for k in range(len(KINDS)):
        after[:, 2 + 2 * k] = first[2 + 2 * k] = -1e4
        after[[1 + 2 * k, 2 + 2 * k], 2 + 2 * k] = 0
    return after, first


def _summed(x: np.ndarray, axis: int) -> np.ndarray:
    most = x.max(axis=axis, keepdims=True)
    return np.log(np.exp(x - most).sum(axis=axis)) + most.squeeze(axis)


def _gradient(rows: np.ndarray, gold: np.ndarray, held: np.ndarray, after: np.ndarray, first: np.ndarray) -> tuple[float, np.ndarray, np.ndarray, np.ndarray]:
    """Log-likelihood of the tags of padded sequences, and its gradients by token, step and first tag."""
    n, length, _ = rows.shape
    ahead, back = np.empty_like(rows), np.zeros_like(rows)
    ahead[:, 0] = first + rows[:, 0]
    for t in range(1, length):
        new = _summed(ahead[:, t - 1, :, None] + after, 1) + rows[:, t]
        ahead[:, t] = np.where(held[:, t, None], new, ahead[:, t - 1])
    for t in range(length - 2, -1, -1):
        new = _summed(after + (rows[:, t + 1] + back[:, t + 1])[:, None, :], 2)
        back[:, t] = np.where(held[:, t + 1, None], new, 0)
    total = _summed(ahead[:, -1], 1)
    likely = np.exp(ahead + back - total[:, None, None]) * held[..., None]
    one = np.eye(TAGS)[gold] * held[..., None]
    steps_, both = np.zeros((TAGS, TAGS)), held[:, 1:]
    for t in range(length - 1):
        pair = np.exp(ahead[:, t, :, None] + after + (rows[:, t + 1] + back[:, t + 1])[:, None, :] - total[:, None, None])
        steps_ -= (pair * both[:, t, None, None]).sum(axis=0)
    np.add.at(steps_, (gold[:, :-1][both], gold[:, 1:][both]), 1)
    begins = (one - likely)[:, 0].sum(axis=0)
    path = (rows * one).sum() + first[gold[:, 0]].sum() + after[gold[:, :-1][both], gold[:, 1:][both]].sum()
    return float(path - total.sum()), one - likely, steps_, begins


def learn(table: list[tuple[str, list[list[tuple[int, int]]]]]) -> Field:
    """A field of greatest penalised likelihood on a labelled table of (text, spans by kind), by Adam."""
    cuts = [tokens(text) for text, _ in table]
    kept = [i for i, c in enumerate(cuts) if c]
    number: dict[str, int] = {}
    after, first = _allowed()
    if not kept:
        return Field(number, np.zeros((1, TAGS)), after, first)
    looks = [[[number.setdefault(f, len(number) + 1) for f in some] for some in features(table[i][0], cuts[i])] for i in kept]
    gold_ = [_tagged(cuts[i], table[i][1]) for i in kept]
    length = max(map(len, looks))
    held = np.arange(length) < np.array([len(x) for x in looks])[:, None]
    gold = np.zeros(held.shape, np.int64)
    gold[held] = np.concatenate(gold_)
    ids = np.array([f for x in looks for f in x])
    token = np.repeat(np.arange(len(ids)), ids.shape[1])
    order = np.argsort(ids.ravel(), kind="stable")
    begins = np.searchsorted(ids.ravel()[order], np.arange(1, len(number) + 1))
    weights = [np.zeros((len(number) + 1, TAGS)), np.zeros((TAGS, TAGS)), np.zeros(TAGS)]
    slow, fast = [np.zeros_like(w) for w in weights], [np.zeros_like(w) for w in weights]
    for t in range(1, EPOCHS + 1):
        rows = np.zeros((*held.shape, TAGS))
        rows[held] = weights[0][ids].sum(axis=1)
        _, by_token, by_step, by_first = _gradient(rows, gold, held, after + weights[1], first + weights[2])
        by_feature = np.zeros_like(weights[0])
        by_feature[1:] = np.add.reduceat(by_token[held][token[order]], begins, axis=0)
        for w, g, m, v in zip(weights, (by_feature, by_step, by_first), slow, fast):
            g = g / len(kept) - DECAY * w
            m *= 0.9
            m += 0.1 * g
            v *= 0.999
            v += 0.001 * g * g
            w += RATE * (m / (1 - 0.9**t)) / (np.sqrt(v / (1 - 0.999**t)) + 1e-8)
    return Field(number, weights[0], after + weights[1], first + weights[2])


def _decoded(field: Field, rows: np.ndarray, lengths: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """The likeliest tag of each token of sequences that follow one another, longest first, by Viterbi a place at a time; and the scores up to it by tag."""
    active = np.searchsorted(-lengths, -np.arange(lengths[0])) if len(lengths) else np.zeros(0, np.int64)
    begins = np.cumsum(active) - active
    places = np.arange(len(rows)) - np.repeat(np.cumsum(lengths) - lengths, lengths)
    order = np.empty(len(rows), np.int64)  # by place, then sequence
    order[begins[places] + np.repeat(np.arange(len(lengths)), lengths)] = np.arange(len(rows))
    best = rows[order]
    after, before = field.after[:, :, None], field.after.T
    for t, (s, n) in enumerate(zip(begins.tolist(), active.tolist())):
        here = best[s : s + n].T
        here += field.first[:, None] if not t else (last[:, None, :n] + after).max(axis=0)
        last = here
    tags = np.empty(len(rows), np.int64)
    at = np.zeros(0, np.int64)
    for s, n in zip(begins[::-1].tolist(), active[::-1].tolist()):
        here = best[s : s + n]
        if len(at):
            here = here.copy()
            here[: len(at)] += before[at]
        at = here.argmax(axis=1)
        tags[order[s : s + n]] = at
    scores = np.empty_like(best)
    scores[order] = best
    return tags, scores


def _batches(field: Field, rows: list[np.ndarray]) -> Iterator[tuple[int, np.ndarray, np.ndarray]]:
    """Number, tags and scores of each sequence, about PLACES tokens at a time."""
    order = sorted(range(len(rows)), key=lambda i: -len(rows[i]))
    begin = 0
    while begin < len(order):
        end, size = begin + 1, len(rows[order[begin]])
        while end < len(order) and size + len(rows[order[end]]) <= PLACES:
            size += len(rows[order[end]])
            end += 1
        lengths = np.array([len(rows[i]) for i in order[begin:end]])
        tags, scores = _decoded(field, np.concatenate([rows[i] for i in order[begin:end]]), lengths)
        cuts = np.cumsum(lengths)[:-1]
        yield from zip(order[begin:end], np.split(tags, cuts), np.split(scores, cuts))
        begin = end


def decode(field: Field, rows: list[np.ndarray]) -> list[np.ndarray]:
    """The likeliest tags of each sequence.

    Long ones are decoded in parts side by side, each with RIM tokens more at both ends. Where the scores
    that a part begins with differ from those its forerunner ends with by one number for all tags, and both
    tag the token where they meet alike, the parts together are the likeliest tags of the whole. Where
    they don't, the sequence is decoded whole.
    """
    made, parts = [], []  # (sequence, begin and end of what a part is for)
    for i, own in enumerate(rows):
        for a in range(0, max(1, len(own)), PART):
            b = min(a + PART, len(own))
            parts.append((i, a, b))
            made.append(own[max(0, a - RIM) : b + RIM])
    found: list = [None] * len(parts)
    for k, tags, scores in _batches(field, made):
        i, a, b = parts[k]
        at = min(a, RIM)
        meets = lambda place: scores[place] - scores[place].max() if 0 <= place < len(scores) else None
        found[k] = (tags[at : at + b - a].copy(), meets(at - 1) if a else None, meets(at + b - a - 1), tags[at + b - a] if b < len(rows[i]) else None)
    out: list[list[np.ndarray]] = [[] for _ in rows]
    again = set()
    for k, (i, a, b) in enumerate(parts):
        tags, begins, ends, beyond = found[k]
        out[i].append(tags)
        if b < len(rows[i]):
            following = found[k + 1]
            if following[0][0] != beyond or np.abs(following[1] - ends).max() > 1e-6:
                again.add(i)
    whole = sorted(again)
    for k, tags, _ in _batches(field, [rows[i] for i in whole]):
        out[whole[k]] = [tags]
    return [np.concatenate(o) for o in out]


#: Classes of code points: white space, parts of words, digits, and signs, which are tokens of their own.
SPACE, WORD, NUMERAL, SIGN = range(4)
#: Names of shapes: of words, of digits by length with and without "v", of ASCII signs, and of others.
SHAPES = [f"{k}{n}" for k in "utl" for n in range(1, 5)] + [f"d{_some(n)}{v}" for n in range(22) for v in ("", "v")] + [chr(c) for c in range(127)] + ["?"]
DIGITS_AT, SIGNS_AT = 12, 12 + 44
#: Names of shapes glued to the token before or not, and of what is beyond a text.
WHOLE = [g + s for g in "+_" for s in SHAPES] + ["end"]
INSIDE = [f"{at}{m}{n}" for at in ("", "@") for m in ("", "m") for n in range(5)]
CUE = ["", *sorted(CUES)]


@cache
def _points() -> tuple[np.ndarray, ...]:
    """Of every code point: class, whether it is a letter, an upper-case one, a cased other, and its small ASCII letter (1 to 26, else 27)."""
    points = [chr(c) for c in range(0x110000)]
    whole = "".join(points)
    kind = np.full(len(points), SIGN, np.uint8)
    for k, pattern in ((SPACE, r"\s+"), (WORD, r"[^\W\d_]+"), (NUMERAL, "[0-9]+")):
        for m in re.finditer(pattern, whole):
            kind[m.start() : m.end()] = k
    flags = [np.fromiter(f, bool, len(points)) for f in (map(str.isalpha, points), map(str.isupper, points), (c.islower() or c.istitle() and not c.isupper() for c in points))]
    small = np.full(len(points), 27, np.int64)
    for c in points:
        if len(low := c.lower()) == 1 and "a" <= low <= "z":
            small[ord(c)] = ord(low) - 96
    return kind, *flags, small


def _packed(letters: np.ndarray, lengths: np.ndarray, begins: np.ndarray) -> np.ndarray:
    """A number for each word of at most seven letters, by these and its length; 0 for longer ones."""
    made = np.where(lengths <= 7, lengths, 0)
    for k in range(7):
        made = made * 32 + np.where((k < lengths) & (lengths <= 7), letters[np.minimum(begins + k, len(letters) - 1)], 0)
    return made


class Looks:
    """The features of a field's tokens, as ``features`` names them, for many texts at once."""

    def __init__(self, field: Field):
        self.field = field
        self.get = lambda f: field.number.get(f, 0)
        named = lambda prefix, names: np.array([self.get(f"{prefix}{n}") for n in names])
        self.shape = named("s", SHAPES)
        self.near = {c: named(c, WHOLE) for c in "gpnPN"}
        self.cue, self.inside, self.hint = named("w", CUE), named("i", INSIDE), named("h", CUE)
        self.numbers: dict[tuple[str, str], int] = {("", ""): 0}
        self.mixed = np.full(len(INSIDE) * len(SHAPES) * len(WHOLE), -1, np.int32)
        small = _points()[4]
        cues = np.array([[int(small[ord(c)]) for c in w.ljust(7)] for w in CUE[1:]])
        lengths = np.array([len(w) for w in CUE[1:]])
        keys = _packed(cues.ravel(), lengths, np.arange(len(cues)) * 7)
        self.cue_order = np.argsort(keys)
        self.cue_keys = keys[self.cue_order]

    def _number(self, m: re.Match) -> int:
        d, parts = _digits(m[0]), re.findall("[0-9]+", m[0])
        dotted = "i" if len(parts) == 4 and len(d) <= 12 and all(int(p) <= 255 for p in parts) else ""
        check = "c" if 13 <= len(d) <= 19 and luhn(d) else ""
        return self.numbers.setdefault((_some(len(d)) + check + dotted, f"{_some(len(parts))}{m[0][0] if m[0][0] in '+(' else ''}"), len(self.numbers))

    def _named(self, codes: np.ndarray, name: Callable[[int], str]) -> np.ndarray:
        """The numbers of the features that ``name`` gives to codes, each distinct code named once."""
        own, at = np.unique(codes, return_inverse=True)
        return np.array([self.get(name(c)) for c in own.tolist()], np.int64)[at]

    def read(self, some: list[str]) -> tuple[list[np.ndarray], list[np.ndarray], list[np.ndarray]]:
        """Of each text: its tokens' begins and ends, and their weights by tag."""
        begins, ends, of, columns = self.tokens(some)
        rows = np.zeros((len(begins), self.field.own.shape[1]))
        for column in columns:
            rows += self.field.own[column]
        cuts = np.searchsorted(of, np.arange(1, len(some)))
        return np.split(begins, cuts), np.split(ends, cuts), np.split(rows, cuts)

    def tokens(self, some: list[str]) -> tuple[np.ndarray, np.ndarray, np.ndarray, Iterator[np.ndarray]]:
        """Begin, end and text of all tokens of the texts, and their features' numbers, one column after the other."""
        kind, alpha, upper, cased, small = _points()
        joined = "\n".join(some) + "\n"  # a break no token, word or number spans
        points = np.frombuffer(joined.encode("utf-32-le"), np.uint32)
        kinds = kind[points]
        new = np.ones(len(points), bool)
        new[1:] = (kinds[1:] != kinds[:-1]) | (kinds[1:] == SIGN)
        bounds = np.append(np.flatnonzero(new), len(points))
        real = np.flatnonzero(kinds[bounds[:-1]] != SPACE)
        begins, ends = bounds[real], bounds[real + 1]
        lengths = ends - begins
        texts_at = np.cumsum([0, *(len(t) + 1 for t in some)])
        of = np.searchsorted(texts_at, begins, side="right") - 1
        if not len(begins):
            return begins, ends, of, iter(())

        kinds_, first = kinds[begins], points[begins]
        runs = np.stack([upper[points], cased[points]])
        uppers, others = (np.add.reduceat(f, bounds[:-1], dtype=np.int64)[real] > 0 for f in runs)
        case = np.where(uppers & ~others, 0, np.where(upper[first], 1, 2))
        value = np.zeros(len(begins), np.int64)
        for k in range(3):
            value = np.where(k < lengths, value * 10 + points[np.minimum(begins + k, len(points) - 1)].astype(np.int64) - 48, value)
        digits = DIGITS_AT + 2 * np.minimum(lengths, 21) + ((lengths <= 3) & (value <= 255))
        shape = np.where(kinds_ == NUMERAL, digits, np.where(alpha[first], case * 4 + np.minimum(lengths, 4) - 1, SIGNS_AT + np.minimum(first, 127)))

        glued = np.ones(len(begins), np.int64)  # of a name's two forms the second: not glued
        glued[1:] = begins[1:] != ends[:-1]
        whole = glued * len(SHAPES) + shape

        def near(k: int) -> np.ndarray:
            out = np.full(len(whole), len(WHOLE) - 1)
            here, there = (slice(k, None), slice(None, -k)) if k > 0 else (slice(None, k), slice(-k, None))
            same = of[here] == of[there]
            out[here] = np.where(same, whole[there], out[here])
            return out

        keys = np.where(kinds_ == WORD, _packed(small[points], lengths, begins), 0)
        place = np.minimum(np.searchsorted(self.cue_keys, keys), len(self.cue_keys) - 1)
        cue = np.where(self.cue_keys[place] == keys, self.cue_order[place] + 1, 0)
        index = np.arange(len(begins))
        last = np.append(-1, np.maximum.accumulate(np.where(cue > 0, index, -1))[:-1])
        hint = np.where((last >= index - 4) & (last >= 0) & (of[last] == of), cue[last], 0)

        black = kinds != SPACE
        starts = np.flatnonzero(black & ~np.append(False, black[:-1]))
        counted = lambda flags: np.add.reduceat(flags, starts, dtype=np.int64)
        ats = points == 64
        ats[starts] = False
        mixed = (counted(alpha[points]) > 0) & (counted(kinds == NUMERAL) > 0)
        words = (counted(ats) > 0) * 10 + mixed * 5 + np.minimum(counted(points == 46), 4)
        inside = words[np.searchsorted(starts, begins, side="right") - 1]

        number = np.zeros(len(begins), np.int64)
        found = [(*m.span(), self._number(m)) for m in NUMBER.finditer(joined)]
        for (a, b), (_, _, n) in zip(np.searchsorted(begins, [f[:2] for f in found]).tolist() if found else [], found):
            number[a:b] = n
        names = list(self.numbers)

        def columns() -> Iterator[np.ndarray]:
            yield self.shape[shape]
            yield self.near["g"][whole]
            yield self.cue[cue]
            before = near(1)
            for name, other in (("p", before), ("n", near(-1)), ("P", near(2)), ("N", near(-2))):
                yield self.near[name][other]
            yield np.array([self.get(f"#{n}") for n, _ in names])[number]
            yield np.array([self.get(f"%{n}/{parts}") for n, parts in names])[number]
            yield self._named(number * len(WHOLE) + whole, lambda c: "&{}/{}/{}/{}".format(*names[c // len(WHOLE)], WHOLE[c % len(WHOLE)][1:], WHOLE[c % len(WHOLE)][0]))
            yield self.inside[inside]
            codes = (inside * len(SHAPES) + shape) * len(WHOLE) + before
            for c in np.unique(codes[self.mixed[codes] < 0]).tolist():
                shape_ = c // len(WHOLE)
                self.mixed[c] = self.get(f"I{INSIDE[shape_ // len(SHAPES)]}/{SHAPES[shape_ % len(SHAPES)]}/{WHOLE[c % len(WHOLE)]}")
            yield self.mixed[codes]
            yield self.hint[hint]
            yield self._named(hint * len(names) + number, lambda c: f"H{CUE[c // len(names)]}/{names[c % len(names)][0]}")

        return begins - texts_at[of], ends - texts_at[of], of, columns()


def plausible(kind: int, text: str) -> bool:
    """Whether an added span has what its kind cannot do without."""
    d = _digits(text)
    if kind == 0:
        # an address goes on after its dot; one that ends a sentence is none of its own
        return bool(re.search(r"@|\bat\b", text, re.IGNORECASE)) and bool(re.search(r"\w\W*\.(?:\w|\s+[a-z0-9])|\b[Dd][Oo][Tt]\b", text))
    if kind == 1:
        parts = re.findall("[0-9]+", text)
        return len(parts) == 4 and all(len(p) <= 3 and int(p) <= 255 for p in parts)
    return 16 <= len(d) <= 19 and luhn(d) if kind == 2 else 7 <= len(d) <= 15


def _joined(spans: list[list[tuple[int, int]]]) -> list[tuple[int, int]]:
    """All spans in order, those that overlap as one."""
    out: list[tuple[int, int]] = []
    for a, b in sorted(s for own in spans for s in own):
        if out and a < out[-1][1]:
            out[-1] = (out[-1][0], max(b, out[-1][1]))
        else:
            out.append((a, b))
    return out


def added(field: Field, some: list[str], base: list[list[list[tuple[int, int]]]], looks: Looks | None = None) -> list[list[list[tuple[int, int]]]]:
    """The spans of each text that the field finds where no base span is, by kind; every token of a text is tagged."""
    out: list[list[list[tuple[int, int]]]] = [[[] for _ in KINDS] for _ in some]
    begins, ends, rows = (looks or Looks(field)).read(some)
    taken = [_joined(own) for own in base]

    def free(i: int, a: int, b: int) -> bool:
        k = bisect_left(taken[i], (b,)) - 1
        return k < 0 or taken[i][k][1] <= a

    for i, tags in enumerate(decode(field, rows)):
        for t in np.flatnonzero(tags % 2).tolist():
            end = t
            while end + 1 < len(tags) and tags[end + 1] == tags[t] + 1:
                end += 1
            k, span = int(tags[t]) // 2, (int(begins[i][t]), int(ends[i][end]))
            if free(i, *span) and plausible(k, some[i][slice(*span)]):
                out[i][k].append(span)
    return out


def prose(text: str) -> list[tuple[int, int]]:
    """What no window of a text takes in, in pieces of at most TAUGHT code points, cut at white space if they have any."""
    out, end = [], 0
    for a, b in [*windows(text), (len(text), len(text))]:
        while end < a:
            cut = max(text.rfind(" ", end + 1, end + TAUGHT), text.rfind("\n", end + 1, end + TAUGHT)) if a - end > TAUGHT else a
            cut = cut if cut > end else end + TAUGHT
            out.append((end, cut))
            end = cut
        end = b
    return out


def labelled(docs: DataFrame, text: str = "text") -> list[tuple[str, list[list[tuple[int, int]]]]]:
    """The labelled table: LINES, and at most SAMPLE windows and PROSE pieces of prose of about DOCUMENTS texts with their base spans, the first in the order of their hashes."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in steps(batches, "text"):
            rows = []
            for t in batch.column("text").to_pylist():
                if not t:
                    continue
                spans = base_spans(t)
                for near, (a, b) in [*((True, w) for w in windows(t)), *((False, w) for w in prose(t))]:
                    if b - a <= TAUGHT:
                        own = [[(x - a, y - a) for x, y in s if x >= a and y <= b] for s in spans]
                        rows.append((t[a:b], listed(own), near))
            yield pa.RecordBatch.from_arrays([pa.array([r[k] for r in rows], kind) for k, kind in enumerate((pa.string(), pa.string(), pa.bool_()))], ["text", "spans", "near"])

    own = docs.select(F.col(text).cast("string").alias("text"))
    some = own.where(F.pmod(F.xxhash64("text"), F.lit(max(1, docs.count() // DOCUMENTS))) == 0)
    found = some.mapInArrow(run, "text string, spans string, near boolean")
    first = lambda near, n: found.where(F.col("near") == near).orderBy(F.xxhash64("text"), "text").limit(n)
    rows = first(True, SAMPLE).unionByName(first(False, PROSE)).collect()
    table = [marked(line) for line in LINES.splitlines()]
    for r in rows:
        spans: list[list[tuple[int, int]]] = [[] for _ in KINDS]
        for part in filter(None, r["spans"].split(",")):
            kind, a, b = part.split(":")
            spans[KINDS.index(kind)].append((int(a), int(b)))
        table.append((r["text"], spans))
    return table


def find(docs: DataFrame, field: Field, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """(doc_id, n_email, n_ip, n_card, n_phone, base_sha256, spans, n_added) of every row.

    The counts and the digest are of the base spans; ``spans`` lists these and the field's
    as kind:start:end, by kind and then start. Null and empty texts hold nothing.
    Repeated rows and null ids stay; columns of the table with these names do no harm.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        names = ["doc_id", *(f"n_{k}" for k in KINDS), "base_sha256", "spans", "n_added"]
        looks = Looks(field)
        for batch in steps(batches, "text"):
            some = [t or "" for t in batch.column("text").to_pylist()]
            base = [base_spans(t) for t in some]
            more = added(field, some, base, looks)
            both = [[sorted(x + y) for x, y in zip(b, m)] for b, m in zip(base, more)]
            columns = [batch.column("doc_id")]
            columns += [pa.array([len(b[k]) for b in base], pa.int64()) for k in range(len(KINDS))]
            columns += [pa.array([hashlib.sha256(listed(b).encode()).hexdigest() for b in base]), pa.array([listed(b) for b in both], pa.string())]
            yield pa.RecordBatch.from_arrays([*columns, pa.array([sum(map(len, m)) for m in more], pa.int64())], names)

    own = docs.select(F.col(doc_id).cast("long").alias("doc_id"), F.col(text).cast("string").alias("text"))
    counted = "".join(f"n_{k} long, " for k in KINDS)
    return own.mapInArrow(run, f"doc_id long, {counted}base_sha256 string, spans string, n_added long")
