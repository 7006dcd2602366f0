"""Personal data: weak supervision over regex, gazetteer and context labelers.

One pass over the texts finds the base spans (fixed patterns and checks) and looser
candidates, and lets six labelers vote on each: personal data, not, or no opinion.
Only where the base rule tested a candidate does it vote; addresses written with words and national
phone numbers, which it does not know, are left to the other labelers. Expectation-maximisation over
the counts of vote patterns estimates each labeler's reliability and a probability for each
pattern (independent labelers given the truth, the Dawid-Skene model; no opinion says nothing). A
logistic span classifier is then trained on these probabilities from the votes, kind and shape
of the candidates, and decides which candidates that are no base spans are added. Patterns
are few whatever the corpus, so the model is fitted on their counts over all documents.
"""

from __future__ import annotations

import hashlib
import re
from bisect import bisect_left
from collections.abc import Iterator
from itertools import accumulate, product

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tokentally.llm.common import settle, ship_code

KINDS = ("email", "ip", "card", "phone")
LABELERS = ("pattern", "shape", "gazetteer", "before", "after", "around")
ADD_FROM = 0.5
#: Probability of a candidate that the base rule accepted to be personal data, and of a refused one not to be.
SURE = 0.99
#: Votes that a labeler's reliability starts from, and the share of them in which each labeler is right.
PRIOR, RIGHT = 50.0, (0.95, 0.7, 0.7, 0.8, 0.7, 0.7)

_IP = re.compile(r"(?<![0-9])[0-9]+(?:\.[0-9]+){3}")
_CARD = re.compile(r"[0-9](?:[ -]?[0-9]){11,}")
_PHONE = re.compile(r"\+[0-9][ ().0-9-]+[0-9]")
_LOCAL = re.compile(r"[A-Za-z0-9._%+-]")
_DOMAIN = re.compile(r"@[A-Za-z0-9-]+(?:\.[A-Za-z0-9-]+)+")
_SPOKEN = re.compile(
    r"(?<![A-Za-z0-9._%+-])[A-Za-z0-9._%+-]++ ?[\[(](?:at|AT)[\])] ?[A-Za-z0-9-]++(?: ?[\[(](?:dot|DOT)[\])] ?[A-Za-z0-9-]++|\.[A-Za-z0-9-]++)++"
)
_NATIONAL = re.compile(r"(?<![0-9+(])\(?[0-9]{3}\)?[ .-][0-9]{3}[ .-][0-9]{4}(?![0-9])")
_DIGIT = re.compile("[0-9]")
_SPOKEN_HINT = re.compile(r"[\[(](?:at|AT)[\])]")
_WORD = re.compile(r"[^\W\d_]+")

# Words that announce each kind, words that announce something else, and words that follow personal data.
CUES = {
    "email": {"email", "mail", "e", "contact", "write", "reach", "kontakt", "courriel", "correo", "adresse", "address", "escribe", "schreib"},
    "ip": {"ip", "host", "server", "address", "adresse", "client", "peer", "from", "node", "gateway", "dns", "login"},
    "card": {"card", "visa", "mastercard", "amex", "credit", "debit", "karte", "kreditkarte", "carte", "tarjeta", "payment"},
    "phone": {"phone", "call", "tel", "telephone", "mobile", "cell", "fax", "telefon", "handy", "telefono", "rufnummer", "whatsapp", "sms", "dial", "ring"},
}
OTHER_CUES = {
    "version", "isbn", "issn", "order", "invoice", "page", "figure", "section", "serial", "bestellung", "commande", "pedido",
    "ticket", "id", "release", "build", "part", "model", "article", "total", "price", "ref", "reference", "number", "no",
}
FOLLOWERS = {"mobile", "home", "work", "office", "ext", "extension", "please", "now", "today", "anytime", "after", "between", "or", "and"}
# Leading digits of card issuers, calling codes, and common top-level domains.
ISSUERS = ("4", "51", "52", "53", "54", "55", "34", "37", "6011", "65", "35", "36", "38", "62", "644", "645", "646", "647", "648", "649", "2221", "23", "24", "25", "26", "270", "271", "2720")
CALLING = (
    "1", "7", "20", "27", "30", "31", "32", "33", "34", "36", "39", "40", "41", "43", "44", "45", "46", "47", "48", "49", "51", "52",
    "53", "54", "55", "56", "57", "58", "60", "61", "62", "63", "64", "65", "66", "81", "82", "84", "86", "90", "91", "92", "93", "94",
    "95", "98", "212", "213", "216", "218", "220", "221", "225", "229", "233", "234", "237", "250", "251", "254", "255", "256", "260",
    "263", "350", "351", "352", "353", "354", "355", "356", "357", "358", "359", "370", "371", "372", "373", "374", "375", "376", "377",
    "380", "381", "382", "385", "386", "387", "389", "420", "421", "423", "502", "503", "504", "505", "506", "507", "591", "593", "595",
    "598", "852", "853", "855", "856", "880", "886", "960", "961", "962", "963", "964", "965", "966", "967", "968", "970", "971", "972",
    "973", "974", "975", "976", "977", "992", "993", "994", "995", "996", "998",
)
DOMAINS = {
    "com", "org", "net", "edu", "gov", "mil", "int", "info", "biz", "io", "ai", "app", "dev", "co", "me", "tv", "de", "fr", "es", "uk", "eu",
    "it", "nl", "ch", "at", "be", "dk", "se", "no", "fi", "ie", "pt", "pl", "cz", "hu", "gr", "ro", "bg", "hr", "si", "sk", "lt", "lv", "ee",
    "ru", "ua", "tr", "il", "in", "cn", "jp", "kr", "hk", "tw", "sg", "au", "nz", "ca", "us", "mx", "br", "ar", "cl", "za", "example", "test",
}


def luhn(digits: str) -> bool:
    total = 0
    for i, d in enumerate(reversed(digits)):
        n = int(d) * (1 + i % 2)
        total += n - 9 * (n > 9)
    return total % 10 == 0


def _digits(s: str) -> str:
    return "".join(c for c in s if "0" <= c <= "9")


def emails(text: str) -> Iterator[tuple[int, int]]:
    """Leftmost, non-overlapping; read from each ``@``, so a long run costs its length once."""
    done, at = 0, text.find("@")
    while at >= 0:
        start = at
        while start > done and _LOCAL.match(text, start - 1):
            start -= 1
        m = _DOMAIN.match(text, at) if start < at else None
        done = m.end() if m else at + 1
        if m:
            yield start, done
        at = text.find("@", done)


def base_and_loose(text: str) -> tuple[list[tuple[int, int, int]], list[tuple[int, int, int]], set[tuple[int, int, int]]]:
    """Base spans, other candidates, and those of them that the base rule tested and refused.

    All as ``(start, kind number, end)`` in code points. Candidates that overlap a base span are left out.
    """
    base, loose, refused = [], [], set()
    if "@" in text:
        base += [(a, 0, b) for a, b in emails(text)]
    if ("[" in text or "(" in text) and _SPOKEN_HINT.search(text):
        loose += [(m.start(), 0, m.end()) for m in _SPOKEN.finditer(text)]
    if _DIGIT.search(text):
        for m in _IP.finditer(text):
            fits = all(len(p.lstrip("0")) <= 3 and int(p.lstrip("0") or 0) <= 255 for p in m[0].split("."))
            (base.append if fits else refused.add)((m.start(), 1, m.end()))
        for m in _CARD.finditer(text):
            digits = _digits(m[0])
            if len(digits) <= 19:
                (base.append if luhn(digits) else refused.add)((m.start(), 2, m.end()))
        if "+" in text:
            for m in _PHONE.finditer(text):
                (base.append if 9 <= len(_digits(m[0])) <= 15 else refused.add)((m.start(), 3, m.end()))
        loose += [(m.start(), 3, m.end()) for m in _NATIONAL.finditer(text)]
    base.sort()
    starts, reach = [a for a, _, _ in base], list(accumulate((b for _, _, b in base), max))

    def apart(span: tuple[int, int, int]) -> bool:
        before = bisect_left(starts, span[2])  # base spans that start before this one ends
        return not before or reach[before - 1] <= span[0]

    return base, [c for c in sorted({*loose, *refused}) if apart(c)], refused


def _sure(yes: bool, no: bool = False) -> int:
    return 1 if yes else 2 if no else 0


def votes(text: str, start: int, kind: int, end: int, rule: int) -> list[int]:
    """One vote for each labeler: 1 personal data, 2 not, 0 no opinion; ``rule`` is the base rule's."""
    span, digits, name = text[start:end], _digits(text[start:end]), KINDS[kind]
    if name == "email":
        shape = _sure(span[-2:].isalpha(), True)
        last = re.search("[A-Za-z]*$", span[-12:])[0].lower()
        listed = _sure(last in DOMAINS)
    elif name == "ip":
        shape = _sure(all(1 <= len(p) <= 3 for p in span.split(".")), True)
        listed = _sure(False, digits[:1] == "0" or span.startswith(("127.", "255.")))
    elif name == "card":
        groups = [len(g) for g in re.split("[ -]", span)]
        shape = _sure(len(groups) == 1 or groups[:-1] == [4] * (len(groups) - 1), True)
        listed = _sure(digits.startswith(ISSUERS), True)
    else:
        shape = _sure(bool(re.search(r"[ .()-]", span)), len(set(digits)) < 3)
        # a national number: area and exchange codes begin with 2 to 9
        listed = _sure(digits.startswith(CALLING)) if span[0] == "+" else _sure(False, digits[:1] in "01" or digits[3:4] in "01")
    words = {w.lower() for w in _WORD.findall(text[max(0, start - 40) : start])[-4:]}
    next_words = {w.lower() for w in _WORD.findall(text[end : end + 24])[:2]}
    near = text[max(0, start - 1) : start] + text[end : end + 1]
    alone = not any(c.isalnum() or c in "_=#/\"'" for c in near)
    before = _sure(bool(words & CUES[name]), bool(words & OTHER_CUES))
    after = _sure(bool(next_words & (FOLLOWERS | CUES[name])), bool(next_words & OTHER_CUES))
    return [rule, shape, listed, before, after, _sure(False, not alone)]


def _pattern(text: str, start: int, kind: int, end: int, rule: int) -> int:
    """Votes, kind, length class and separator class of a candidate, as one small number."""
    code = 0
    for v in votes(text, start, kind, end, rule):
        code = 3 * code + v
    span = text[start:end]
    length = min(3, (end - start) // 8)
    marks = min(3, sum(not c.isalnum() for c in span))
    return ((code * 4 + kind) * 4 + length) * 4 + marks


def _unpack(pattern: int) -> tuple[list[int], int, int, int]:
    code, marks = divmod(pattern, 4)
    code, length = divmod(code, 4)
    code, kind = divmod(code, 4)
    found = []
    for _ in LABELERS:
        code, v = divmod(code, 3)
        found.append(v)
    return found[::-1], kind, length, marks


def _features(patterns: list[int]) -> np.ndarray:
    x = np.zeros((len(patterns), 1 + 3 * len(LABELERS) + 12))
    for row, pattern in zip(x, patterns):
        found, *classes = _unpack(pattern)
        row[0] = 1
        row[[1 + 3 * i + v for i, v in enumerate(found)]] = 1
        row[[1 + 3 * len(LABELERS) + 4 * i + c for i, c in enumerate(classes)]] = 1
    return x


def reliabilities(patterns: list[int], counts: np.ndarray, rounds: int = 50) -> tuple[np.ndarray, np.ndarray]:
    """Vote probabilities ``[labeler, truth, vote]`` and each pattern's probability to be personal data.

    Votes are 1 and 2 of the last axis; a labeler without an opinion on a pattern has no part in it.
    Each labeler starts from ``PRIOR`` votes of which ``RIGHT`` say it is right, so one that is
    seldom heard, or heard on one side only, is neither believed blindly nor turned round. What the
    base rule accepted or refused (a check digit, a range) anchors the estimate: the other labelers are
    measured by it, and the candidates that it did not test are judged by them.
    """
    found = np.array([_unpack(p)[0] for p in patterns])
    right = np.array(RIGHT)
    prior = PRIOR * np.stack([np.stack([0 * right, 1 - right, right], 1), np.stack([0 * right, right, 1 - right], 1)], 1)
    table, share = prior / PRIOR, np.array([0.5, 0.5])
    for _ in range(rounds):
        table[:, :, 0] = 1
        logs = np.log(share)[:, None] + sum(np.log(table[i][:, found[:, i]]) for i in range(len(LABELERS)))
        belief = 1 / (1 + np.exp(np.clip(logs[0] - logs[1], -50, 50)))
        belief = np.choose(found[:, 0], (belief, SURE, 1 - SURE))  # what the base rule tested is known
        weight = np.stack([counts * (1 - belief), counts * belief])
        share = (weight.sum(1) + 1) / (weight.sum() + 2)
        for i, truth, vote in product(range(len(LABELERS)), (0, 1), (1, 2)):
            table[i, truth, vote] = weight[truth][found[:, i] == vote].sum() + prior[i, truth, vote]
        table[:, :, 1:] /= table[:, :, 1:].sum(2, keepdims=True)
    return table, belief


def train(patterns: list[int], counts: np.ndarray, steps: int = 300) -> np.ndarray:
    """Weights of the span classifier: logistic regression on the patterns' probabilities."""
    x = _features(patterns)
    _, belief = reliabilities(patterns, counts)
    weight, w = counts / counts.sum(), np.zeros(x.shape[1])
    for _ in range(steps):
        p = 1 / (1 + np.exp(-x @ w))
        slope = x.T @ (weight * (p - belief)) + 1e-4 * w
        curve = (x * (weight * np.maximum(p * (1 - p), 0.02))[:, None]).T @ x + 1e-3 * np.eye(len(w))
        w -= 0.5 * np.linalg.solve(curve, slope)
    return w


SPAN = "struct<start:int,kind:int,end:int>"
FOUND = f"doc_id bigint, base array<{SPAN}>, base_patterns array<int>, loose array<{SPAN}>, loose_patterns array<int>"
_SPANS = pa.list_(pa.struct([("start", pa.int32()), ("kind", pa.int32()), ("end", pa.int32())]))


def _found(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    def spans(rows):
        return pa.array([[dict(zip(("start", "kind", "end"), s)) for s in r] for r in rows], _SPANS)

    for batch in batches:
        base, loose, pb, pl = [], [], [], []
        for text in batch.column(1).to_pylist():
            text = text or ""
            b, c, refused = base_and_loose(text)
            base.append(b)
            loose.append(c)
            pb.append([_pattern(text, *s, 1) for s in b])
            pl.append([_pattern(text, *s, 2 if s in refused else 0) for s in c])
        ints = pa.list_(pa.int32())
        columns = [batch.column(0), spans(base), pa.array(pb, ints), spans(loose), pa.array(pl, ints)]
        yield pa.RecordBatch.from_arrays(columns, names=["doc_id", "base", "base_patterns", "loose", "loose_patterns"])


def find_candidates(docs: DataFrame) -> DataFrame:
    """Base spans and looser candidates of each row, with the number of each one's pattern."""
    ship_code(docs.sparkSession)
    docs = docs.select(F.col("doc_id").cast("bigint").alias("doc_id"), F.col("text").alias("text"))
    return docs.mapInArrow(_found, FOUND)


def _written(spans: list[tuple[int, int, int]]) -> str:
    return ",".join(f"{KINDS[k]}:{a}:{b}" for a, k, b in sorted(spans))


def _decided(added: set[int]):
    names = ["doc_id", *(f"n_{k}" for k in KINDS), "base_sha256", "spans", "n_added", "n_spans"]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            rows = []
            for r in batch.to_pylist():
                base = [(s["start"], s["kind"], s["end"]) for s in r["base"]]
                more = [(s["start"], s["kind"], s["end"]) for s, p in zip(r["loose"], r["loose_patterns"]) if p in added]
                counts = [sum(k == i for _, k, _ in base) for i in range(len(KINDS))]
                digest = hashlib.sha256(_written(base).encode()).hexdigest()
                rows.append((r["doc_id"], *counts, digest, _written(base + more), len(more), len(base) + len(more)))
            types = [pa.int64()] * 5 + [pa.string(), pa.string(), pa.int64(), pa.int64()]
            columns = list(zip(*rows)) or [[]] * len(types)
            yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(columns, types)], names=names)

    return run


def find_personal_data(docs: DataFrame) -> DataFrame:
    """``[doc_id, n_email, n_ip, n_card, n_phone, base_sha256, spans, n_added, n_spans]`` per row of ``docs [doc_id, text]``.

    The counts and the checksum are of the base spans; ``spans`` (``n_spans``) also holds those that
    the classifier adds (``n_added``), all as ``kind:start:end`` by start, then kind.
    A null or empty text has none. Repeated rows and null ids are carried along; other
    columns are ignored. Without any candidate nothing is trained; an empty table
    gives an empty result.
    """
    found = settle(find_candidates(docs), "candidates")
    seen = found.select(F.explode(F.concat("base_patterns", "loose_patterns")).alias("pattern"))
    counts = {r["pattern"]: r["count"] for r in seen.groupBy("pattern").count().collect()}  # bounded: 3**6 * 64
    patterns, added = sorted(counts), set()
    if patterns:
        w = train(patterns, np.array([counts[p] for p in patterns], float))
        p = 1 / (1 + np.exp(-_features(patterns) @ w))
        added = {pattern for pattern, chance in zip(patterns, p) if chance >= ADD_FROM}
    schema = "doc_id bigint, n_email bigint, n_ip bigint, n_card bigint, n_phone bigint, base_sha256 string, spans string, n_added bigint, n_spans bigint"
    return found.mapInArrow(_decided(added), schema)
