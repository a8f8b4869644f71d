"""Personal data: base spans against plain patterns, the field against sums over all tag paths and held-out lines."""

import hashlib
import itertools
import random
import re

import numpy as np
import pytest

from reliefgrid.llm import personal

PLAIN = [r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+", r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)", r"[0-9]([\x20-]?[0-9])+", r"\+[0-9][\x20().0-9-]+[0-9]"]


def brute(text):
    checks = [lambda m: True, lambda m: all(int(p) <= 255 for p in m.split(".")), lambda m: 16 <= len(d := re.sub("[^0-9]", "", m)) <= 19 and sum(sum(divmod(2 * int(c), 10)) if i % 2 else int(c) for i, c in enumerate(d[::-1])) % 10 == 0, lambda m: 8 <= len(re.sub("[^0-9]", "", m)) <= 15]
    return [[m.span() for m in re.finditer(p, text) if ok(m[0])] for p, ok in zip(PLAIN, checks)]


TEXTS = [
    "mail a.b@c.d@e.f x@y z@ @q.r me@host.example.com. é@ü.com ü.a@b.c",
    "1.2.3.4.5.6.7.8 999.1.1.1 256.1.1.1 1.1.1.256.1.1.1 01.02.03.004 1..2.3.4",
    "4111 1111 1111 1111 4111-1111-1111-1112 41111111111111111 4736962573099581 1 4111111111111111",
    "+1 (243) 555-5526 +12 +1-2 +1 2 3 4 5 6 7 8 +() +123456789012345678 ++1.2.3.4.5.6.7.8 +49 30 5557713.",
    "", " ", "plain words only", "１２３ ٣٤", "9" * 400, "." * 400, "a@" * 300, "@" * 300, "+" * 300 + "1" * 9,
]


def test_base_spans():
    rng = random.Random(6)
    texts = TEXTS + ["".join(rng.choice("0123456789 .-+@()ab\n%é") for _ in range(rng.randrange(80))) for _ in range(3000)]
    texts += ["".join(rng.choice(["1.2.3.4", "+49 ", "4111 1111 1111 1111", "a@b.c", " ", "-", ".", "255", "256", "7"]) for _ in range(12)) for _ in range(1000)]
    for text in texts:
        assert personal.base_spans(text) == brute(text), text


def test_long_texts_take_linear_time():
    for text in ("a" * 1_000_000, "1" * 1_000_000, "1 " * 500_000, "1.2." * 250_000, "a.b@" * 250_000, "+1" * 500_000):
        personal.base_spans(text)
        assert sum(b - a for a, b in personal.windows(text)) <= len(text)


@pytest.fixture(scope="module")
def lines():
    return [personal.marked(line) for line in personal.LINES.splitlines()]


def test_marked():
    text, spans = personal.marked("a [email x [at] y.z] or [phone 1 2]")
    assert text == "a x [at] y.z or 1 2" and [[text[a:b] for a, b in s] for s in spans] == [["x [at] y.z"], [], [], ["1 2"]]


def test_gradient_and_viterbi(monkeypatch):
    monkeypatch.setattr(personal, "TAGS", 3)
    rng = np.random.default_rng(8)
    lengths = [1, 4, 3]
    rows, after, first = rng.normal(size=(3, 4, 3)), rng.normal(size=(3, 3)), rng.normal(size=3)
    held = np.arange(4) < np.array(lengths)[:, None]
    gold = rng.integers(0, 3, (3, 4)) * held

    def score(k, path):
        return first[path[0]] + sum(rows[k, t, y] for t, y in enumerate(path)) + sum(after[a, b] for a, b in zip(path, path[1:]))

    want, best, likely, steps = 0.0, [], np.zeros((3, 4, 3)), np.zeros((3, 3))
    for k, n in enumerate(lengths):
        paths = list(itertools.product(range(3), repeat=n))
        scores = np.array([score(k, p) for p in paths])
        share = np.exp(scores) / np.exp(scores).sum()
        want += score(k, gold[k, :n]) - np.log(np.exp(scores).sum())
        best.append(paths[scores.argmax()])
        for p, s in zip(paths, share):
            for t, y in enumerate(p):
                likely[k, t, y] += s
            for a, b in zip(p, p[1:]):
                steps[a, b] -= s
        for a, b in zip(gold[k, :n], gold[k, 1:n]):
            steps[a, b] += 1
    value, by_token, by_step, _ = personal._gradient(rows, gold, held, after, first)
    assert np.isclose(value, want) and np.allclose(by_step, steps)
    assert np.allclose(by_token, np.eye(3)[gold] * held[..., None] - likely)
    field = personal.Field({}, np.zeros((1, 3)), after, first)
    assert [tuple(t) for t in personal.decode(field, [rows[k, :n] for k, n in enumerate(lengths)])] == best


def test_parts_are_decoded_like_the_whole(monkeypatch):
    rng = np.random.default_rng(1)
    again, batches = [], personal._batches
    monkeypatch.setattr(personal, "_batches", lambda field, rows: (again.append(len(rows)), batches(field, rows))[1])
    for _ in range(30):
        field = personal.Field({}, np.zeros((1, 9)), rng.normal(size=(9, 9)) * 3 + personal._allowed()[0], rng.normal(size=9))
        rows = [rng.normal(size=(int(rng.integers(0, 60)), 9)) * rng.choice([0.3, 1, 3]) for _ in range(20)]
        monkeypatch.setattr(personal, "PART", 1000)
        whole = personal.decode(field, rows)
        monkeypatch.setattr(personal, "PART", 7)
        monkeypatch.setattr(personal, "RIM", 3)
        assert all(np.array_equal(a, b) for a, b in zip(personal.decode(field, rows), whole, strict=True))
    assert 0 < sum(again[3::4]) < 20 * 30  # some are decoded again, not all


def test_held_out_lines(lines):
    field = personal.learn(lines)
    for line in ("tel 0231 555 7713 please", "we know that [phone (555) 123-4567] is his", "ask [email eva (at) host.example.com] now", "pay with [card 4716 3208.9361 0054] here"):
        text, spans = personal.marked(line.replace("0231 555 7713", "[phone 0231 555 7713]"))
        assert personal.added(field, [text], [personal.base_spans(text)]) == [spans], line
    clean = ["in 1999 at 10.30 he left", "room 12, 3rd floor", 'token = "0b96a8c8d79c4a5085c919698889f59b72ab7bb6"', "License, version 3.", "under CC BY-NC 4.0.", "order 4716320893610055 is late"]
    assert personal.added(field, clean, [personal.base_spans(t) for t in clean]) == [[[], [], [], []]] * len(clean)


def test_every_token_of_a_text_is_tagged(lines):
    prose = "they walked along the river and talked of old friends "
    field = personal.learn(lines + [(prose, [[], [], [], []])] * 20)
    text, spans = personal.marked(f"{prose}\nwrite to [email anna.berg at mail.example.com] before noon {prose}")
    assert personal.added(field, [text], [personal.base_spans(text)]) == [spans]
    # numbers so dense that their surroundings meet for longer than the longest window
    line = "the score was 3 to 1 after 90 minutes and\n"
    for shift in range(0, 12, 3):
        n = (personal.LONGEST - 20) // len(line)
        before = line * n + "x" * (personal.LONGEST - 16 - n * len(line) + shift) + " "
        text, spans = personal.marked(f"{before}tel [phone 0231 555 7713] please\n{line}")
        assert spans[3][0] in personal.added(field, [text], [personal.base_spans(text)])[0][3]


def test_looks_are_the_features(lines):
    field = personal.learn(lines)
    rng = random.Random(9)
    parts = ["1.2.3.4", "+49 ", "(030) 555-77", "a@b.c", " ", "\n", "-", ".", "at", " AT ", "dot", "Version ", "255", "256", "É", "ß", "ǅ", "²x", "½", "\u212a", "to\u212aen", "٣", "_", "/", "東京", "License", "4716 3208 9361 0054", "x" * 5, "9" * 24, "\x7f", "\x1c", "İp", "@"]
    some = ["", " ", "one", *(t for t, _ in lines)] + ["".join(rng.choice(parts) for _ in range(rng.randrange(1, 40))) for _ in range(800)]
    begins, ends, rows = personal.Looks(field).read(some)
    for text, a, b, own in zip(some, begins, ends, rows, strict=True):
        cut = personal.tokens(text)
        assert list(zip(a.tolist(), b.tolist())) == cut, text
        assert not cut or np.allclose(own, field.rows(personal.features(text, cut))), text
    assert [len(x) for x in personal.Looks(field).read(["", " "])[0]] == [0, 0] and personal.Looks(field).read([]) is not None


def test_find(spark, documents, empty, lines):
    field = personal.learn(lines)
    own = [r["text"] for r in documents.collect()] + [*TEXTS, "tel 0231 555 7713 and me@host.example.com", None]
    rows = [(None if i % 7 == 0 else i // 2, t, "x", 1, 2, 3) for i, t in enumerate(own)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, spans string, n_email int, doc int, key int").repartition(3)
    made = sorted((str(r["doc_id"]), r["spans"], r["base_sha256"], *(r[f"n_{k}"] for k in personal.KINDS)) for r in personal.find(docs, field).collect())
    want = []
    for i, t, *_ in rows:
        base = brute(t or "")
        more = personal.added(field, [t or ""], [base])[0]
        text = personal.listed([sorted(x + y) for x, y in zip(base, more)])
        want.append((str(i), text, hashlib.sha256(personal.listed(base).encode()).hexdigest(), *map(len, base)))
    assert made == sorted(want)
    assert not personal.find(empty, field).collect()
    assert personal.learn(personal.labelled(empty)).own.shape[1] == personal.TAGS


def test_no_table():
    field = personal.learn([])
    assert personal.added(field, ["call 030 555 7713"], [[[], [], [], []]]) == [[[], [], [], []]]
