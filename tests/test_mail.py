"""Postal codes and visible text."""

import random
import re
from datetime import date, datetime

import pytest

from ebbtide import schemas
from ebbtide.functions import codes, html
from ebbtide.plans import mail

FAR = "x" * 60


@pytest.mark.parametrize(
    "text, want",
    [
        ("entregar no CEP: 04321-090 ou 87650431", ["04321-090", "87650-431"]),
        ("mudou para o CEP 40150160", ["40150-160"]),
        (f"{FAR} 20240101 {FAR}", []),
        (f"{FAR} 00123456", []),
        (f"{FAR} 41000222", ["41000-222"]),
        (f"20240101 {'x' * 37} cep", ["20240-101"]),
        (f"20240101 {'x' * 38} cep", []),
        (f"cep{'.' * 46} 20240101", ["20240-101"]),
        (f"cep{'.' * 47} 20240101", []),
        ("40000-1234 140000-123 40000 - 123", ["40000-123"]),
        ("a41000222 41000222b 410002223 é41000222", []),
        ("cep : 65010 440", ["65010-440"]),
        (None, None),
    ],
)
def test_codes(column, text, want):
    assert column([text], "string", codes.postal_codes) == [want]


def test_cap(column):
    many = [f"{30000000 + i}" for i in range(25)]
    (got,) = column([" ".join(many)], "string", codes.postal_codes)
    assert got == [f"{m[:5]}-{m[5:]}" for m in many[:20]]


class Scanner:
    """Steps through a text by hand; a step that does not fit ends in None."""

    def __init__(self, text):
        self.text = text
        self.words = [i for i in range(len(text)) if text[i : i + 3].upper() == "CEP"]

    def digits(self, at, n):
        part = self.text[at : at + n] if at is not None else ""
        return at + n if len(part) == n and all(c.isdecimal() for c in part) else None

    def spaces(self, at):
        while at is not None and self.text[at : at + 1].isspace():
            at += 1
        return at

    def one(self, at, sign, must=False):
        if at is not None and self.text[at : at + 1] == sign:
            return at + 1
        return None if must else at

    def outside(self, at):
        """No letter, digit or underscore stands at this place."""
        return not (0 <= at < len(self.text) and (self.text[at].isalnum() or self.text[at] == "_"))

    def split_code(self, at, dash):
        """End of five digits and three, with a dash between them if it has to be."""
        five = self.spaces(self.digits(at, 5))
        return self.digits(self.spaces(self.one(five, "-", dash)), 3)

    def finds(self, starts, end_of):
        """Codes of finds that do not overlap, from left to right."""
        at = 0
        for start in starts:
            end = end_of(start) if start >= at else None
            if end is not None:
                yield "".join(c for c in self.text[start:end] if c.isdecimal())
                at = end

    def near(self, at):
        """A word lies wholly within 50 characters before the place, or behind it."""
        return any(at - 50 <= w <= at - 3 or at <= w <= at + 47 for w in self.words)


def brute_force(text, cap=20):
    """Codes and the number of those that the cap left out."""
    s = Scanner(text)
    everywhere = range(len(text))
    listed = list(s.finds(s.words, lambda w: s.split_code(s.spaces(s.one(s.spaces(w + 3), ":")), False)))

    def alone(at):
        end = s.split_code(at, True) if s.outside(at - 1) else None
        return end if end is not None and s.outside(end) else None

    listed += s.finds(everywhere, alone)
    dropped = 0
    for at in everywhere:
        if s.digits(at, 8) is None or not s.outside(at - 1) or not s.outside(at + 8):
            continue
        code = text[at : at + 8]
        if s.near(at) or code[:2] not in ("00", "19", "20", "21") and len(listed) < cap:
            listed.append(code)
        elif code[:2] not in ("00", "19", "20", "21"):
            dropped += 1
    return list(dict.fromkeys(f"{c[:5]}-{c[5:]}" for c in listed)), dropped


def test_codes_against_brute_force(column):
    rng = random.Random(7)
    words = ["CEP", "cep:", "Ceps", "rua", "é", "-", " - ", ":", "\n", "_", "19", "x" * 30]

    def token():
        n = rng.choice([3, 5, 8, 8, 8, 9])
        return rng.choice([rng.choice(words), "".join(rng.choices("0123456789", k=n)), str(rng.randint(10000, 99999)) + "-" + str(rng.randint(100, 999))])

    texts = ["".join(token() + rng.choice(["", " ", " ", " " * 12]) for _ in range(rng.randint(1, 80))) for _ in range(1500)]
    for cap in (20, 5):
        got = column(texts, "string", lambda c, cap=cap: codes.code_lists(c, cap))
        wrong = [(t, tuple(g), brute_force(t, cap)) for t, g in zip(texts, got) if tuple(g) != brute_force(t, cap)]
        assert not wrong, wrong[0]
        assert sum(g["dropped"] for g in got) > 100
    got = column(texts, "string", codes.postal_codes)
    assert sum(len(g) >= 20 for g in got) > 100


@pytest.mark.parametrize(
    "page, want",
    [
        ("<td>CEP <i>70040-010</i></td>", "CEP 70040-010"),
        ("<style>a{}</style>x<SCRIPT src='q'>if (a<b) {}</SCRIPT >y", "x y"),
        ("a<!-- <b> -->b<br/>c", "a b c"),
        ("caf&eacute; &#233; &#xE9; &copy 2020 &nbsp; fim", "café é é © 2020 fim"),
        ("a &amp;lt; b", "a < b"),
        ("&apos;a&#150;b&#x96;&lsqb; &notit; &not it &NotEqualTilde;", "'a–b–[ ¬it; ¬ it ≂̸"),
        ("x&#0;&#1114112;&#55296;y", "x\ufffd\ufffd\ufffdy"),
        ("5 < 6 & 7 > 2 AT&T &unknown;", "5 < 6 & 7 > 2 AT&T &unknown;"),
        ("", ""),
        (None, None),
    ],
)
def test_html(column, page, want):
    assert column([page], "string", html.html_text) == [want]


@pytest.fixture(scope="module")
def messages(spark):
    rows = [
        ("in", 1, datetime(2024, 1, 1), "a", "CEPS da lista", "41000222 " + FAR, None),
        ("in", 2, datetime(2024, 1, 2), "b", "oi", "CEPS 41000-222", None),  # plural in the body only
        ("in", 3, datetime(2024, 1, 3), "c", "oi", None, "<p>CEP <b>41000-222</b></p>"),
        ("in", 4, datetime(2024, 1, 4), "d", None, " cep sem numero ", "<p>41000-222</p>"),
        ("out", 1, datetime(2024, 1, 4), "e", "x" * 90 + " CEP 41000-222 40000-111", "", None),
    ]
    return spark.createDataFrame(rows, schemas.MAIL)


def test_report(messages):
    got = {(r["folder"], r["uid"]): r for r in mail.code_report(messages).collect()}
    assert set(got) == {("in", 1), ("in", 3), ("out", 1)}
    assert got["in", 3]["body"] == "CEP 41000-222"
    assert len(got["out", 1]["subject"]) == 100 and got["out", 1]["codes"] == "41000-222, 40000-111"
    assert got["out", 1]["quantity"] == 2


def test_totals(messages):
    got = {r["folder"]: (r["with_codes"], r["without_codes"], r["codes"]) for r in mail.code_totals(messages).collect()}
    assert got == {"in": (2, 2, 2), "out": (1, 0, 2)}


def test_scan(messages):
    def ids(**options):
        return sorted((r["folder"], r["uid"]) for r in mail.scan(messages, **options).collect())

    assert ids(since=date(2024, 1, 3), last=1) == [("in", 4), ("out", 1)]
    assert ids(last=2, folders=["in"]) == [("in", 3), ("in", 4)]
    assert len(ids()) == 5


def test_search_runs_once_per_message(messages):
    plan = mail.code_report(messages)._jdf.queryExecution().optimizedPlan().toString()
    assert plan.count("regexp_extract_all") <= 8
