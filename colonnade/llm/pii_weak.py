"""Operator 4: personal data by base patterns and weakly supervised extra spans.

Base kinds (email, ip, card, phone) are leftmost non-overlapping matches with their checks.
Extra candidates (national phone and id numbers, spelled-out addresses, long secrets) get votes of
three labelers: shape patterns, gazetteers and context words.  Votes are counted over the whole corpus per
feature pattern (a bounded table); expectation-maximisation estimates the labelers' reliabilities,
and a logistic classifier on the features, trained on the posteriors, decides.

Null text is empty: counts are 0, spans ''.  Long texts are linear: no pattern rescans a run.
Repeated rows are judged alike; empty tables give no rows; other columns are not read.
"""

from __future__ import annotations

import hashlib
import re
from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from colonnade.llm.text import materialise, portable

KINDS = ("email", "ip", "card", "phone")
EXTRA = ("phone", "id", "email", "secret")

_LOCAL = frozenset("ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789._%+-")
_DOMAIN = re.compile(r"[A-Za-z0-9-]+(?:\.[A-Za-z0-9-]+)+")
_IP = re.compile(r"(?<![0-9])[0-9]++(?:\.[0-9]+){3}")
_CARD = re.compile(r"[0-9](?:[\x20-]?[0-9])+")
_PHONE = re.compile(r"\+[0-9][\x20().0-9-]+[0-9]")


def emails(text: str) -> Iterator[tuple[int, int]]:
    """Leftmost matches of the email rule, found from each @ outwards in linear time."""
    end = 0
    at = text.find("@")
    while at >= 0:
        start = at
        while start > end and text[start - 1] in _LOCAL:
            start -= 1
        m = _DOMAIN.match(text, at + 1) if start < at else None
        if m:
            yield start, m.end()
        end = m.end() if m else at + 1
        at = text.find("@", end)


def luhn(digits: str) -> bool:
    total = 0
    for i, d in enumerate(reversed(digits)):
        n = int(d) * (1 + i % 2)
        total += n - 9 * (n > 9)
    return total % 10 == 0


def base_spans(text: str) -> list[tuple[int, int, int]]:
    """(start, kind number, end), sorted."""
    out = [(s, 0, e) for s, e in emails(text)] if "@" in text else []
    for m in _IP.finditer(text):
        if all(len(p.lstrip("0")) <= 3 and int(p.lstrip("0") or "0") <= 255 for p in m.group().split(".")):
            out.append((m.start(), 1, m.end()))
    for m in _CARD.finditer(text):
        digits = re.sub("[^0-9]", "", m.group())
        if 14 <= len(digits) <= 19 and luhn(digits):
            out.append((m.start(), 2, m.end()))
    if "+" in text:
        for m in _PHONE.finditer(text):
            if 10 <= sum(c.isdigit() for c in m.group()) <= 15:
                out.append((m.start(), 3, m.end()))
    return sorted(out)


# IBAN lengths of the gazetteer's countries: printed in groups of four, the last one may be shorter.
_IBAN = {"DE": 22, "FR": 27, "ES": 24, "GB": 22, "IT": 27, "NL": 18, "BE": 16, "AT": 20, "CH": 21, "PT": 25}
_IBANS = "|".join(rf"{c}[0-9]{{2}}(?:\x20?[A-Z0-9]{{4}}){{{n // 4 - 1}}}" + (rf"\x20?[A-Z0-9]{{{n % 4}}}" if n % 4 else "") for c, n in _IBAN.items())
# Extra candidates: one pattern per kind, wide on purpose; the labelers judge them.
_WIDE = (
    re.compile(r"(?<![0-9.+-])\(?[0-9]{2,5}\)?[\x20/.-][0-9]{3,4}[\x20.-][0-9]{3,5}(?![0-9])"),
    # A listed country's exact length first; else any groups of four, a shorter last one with a digit (no word that follows).
    re.compile(r"(?<![0-9-])[0-9]{3}-[0-9]{2}-[0-9]{4}(?![0-9-])|\b(?:" + _IBANS +
               r")\b|\b[A-Z]{2}[0-9]{2}(?:\x20?[A-Z0-9]{4}){3,7}(?:[A-Z0-9]{1,3}|\x20(?=[A-Z]{0,2}[0-9])[A-Z0-9]{1,3})?\b"),
    re.compile(r"\b[A-Za-z0-9._-]{1,64}\x20?[\[(](?:at|AT)[\])]\x20?[A-Za-z0-9-]{1,63}(?:\x20?(?:[\[(]dot[\])]|\.)\x20?[A-Za-z]{2,20}){1,4}"),
    re.compile(r"(?<![A-Za-z0-9_-])[A-Za-z0-9_-]{24,}+"),
)
# The context labeler's words per kind and the gazetteers.
_CONTEXT = (
    ("call", "phone", "tel", "telephone", "mobile", "fax", "anruf", "telefon", "llame", "appelez"),
    ("ssn", "social", "iban", "passport", "account", "konto", "cuenta", "compte"),
    ("mail", "email", "e-mail", "contact", "write", "kontakt", "correo", "courriel"),
    ("token", "key", "secret", "password", "apikey", "api_key", "bearer"),
)
_AREA = ("202", "212", "213", "305", "312", "415", "555", "617", "702", "713", "030", "089", "040")
_COUNTRY = tuple(_IBAN)
_TLD = ("com", "org", "net", "edu", "de", "fr", "es", "uk", "io")
_PREFIX = ("sk", "pk", "ghp", "AKIA", "xox", "eyJ")
_STRICT = (re.compile(r"\(?0?[0-9]{2,4}\)?[\x20-][0-9]{3}-[0-9]{4}"), re.compile(r"(?!000|666|9)[0-9]{3}-(?!00)[0-9]{2}-(?!0000)[0-9]{4}|[A-Z]{2}.*"),
           re.compile(r".*(?:dot|\.).*"), re.compile(r"(?=.*[0-9])(?=.*[A-Za-z]).{32,}"))
ABSTAIN = 2


def extra_candidates(text: str, taken: list[tuple[int, int, int]]) -> list[tuple[int, int, int, int]]:
    """(start, kind, end, code) of candidates that do not overlap base spans; code packs kind, three votes, features."""
    out = []
    for kind, pattern in enumerate(_WIDE):
        for m in pattern.finditer(text):
            s, e = m.span()
            if any(a < e and s < b for a, _, b in taken):
                continue
            body = m.group()
            if kind == 3 and not (any(c.isdigit() for c in body) and any(c.isalpha() for c in body)):
                continue
            shape = 1 if _STRICT[kind].fullmatch(body) else 0
            if kind == 0:
                known = 1 if body.lstrip("(")[:3] in _AREA else ABSTAIN
            elif kind == 1:
                known = 1 if body[:2] in _COUNTRY else (ABSTAIN if body[0].isdigit() else 0)
            elif kind == 2:
                known = 1 if re.split(r"[^A-Za-z]+", body)[-1].lower() in _TLD else 0
            else:
                known = 1 if body.startswith(_PREFIX) else ABSTAIN
            before = re.findall(r"[\w-]+", text[max(0, s - 40):s].lower())[-4:]
            around = 1 if any(w in _CONTEXT[kind] for w in before) else (0 if before and before[-1].isdigit() else ABSTAIN)
            quoted = int(s > 0 and text[s - 1] in "\"'=:(")
            wide = int(len(body) >= (14, 16, 24, 40)[kind])
            out.append((s, kind, e, (((kind * 3 + shape) * 3 + known) * 3 + around) * 4 + quoted * 2 + wide))
    return out


def fit_votes(counts: dict[int, int], rounds: int = 50) -> set[int]:
    """Feature codes to accept: EM over labeler reliabilities, then logistic regression on the features."""
    if not counts:
        return set()
    codes = np.array(sorted(counts))
    n = np.array([counts[c] for c in codes], float)
    votes = np.stack([codes // 36 % 3, codes // 12 % 3, codes // 4 % 3], 1)
    kind = codes // 108
    prior = np.full(len(EXTRA), 0.5)
    # Start: labelers are right more often than not; Laplace counts keep estimates inside (0, 1).
    hit = np.array([[0.15, 0.7, 0.15]] * 3)
    miss = np.array([[0.6, 0.1, 0.3]] * 3)
    post = np.full(len(codes), 0.5)
    for _ in range(rounds):
        a, b = np.log(prior[kind]), np.log(1 - prior[kind])
        for j in range(3):
            a = a + np.log(hit[j, votes[:, j]])
            b = b + np.log(miss[j, votes[:, j]])
        post = 1 / (1 + np.exp(b - a))
        for k in range(len(EXTRA)):
            prior[k] = (1 + (n * post)[kind == k].sum()) / (2 + n[kind == k].sum())
        for j in range(3):
            for v in range(3):
                on = votes[:, j] == v
                hit[j, v] = (2 * (0.7 if v == 1 else 0.15) + (n * post)[on].sum()) / (2 + (n * post).sum())
                miss[j, v] = (2 * (0.1 if v == 1 else 0.45) + (n * (1 - post))[on].sum()) / (2 + (n * (1 - post)).sum())
    x = np.column_stack([np.ones(len(codes)), *(votes[:, j] == v for j in range(3) for v in (0, 1)),
                         codes // 2 % 2, codes % 2, *(kind == k for k in range(1, len(EXTRA)))]).astype(float)
    beta = np.zeros(x.shape[1])
    for _ in range(25):  # Newton steps on weighted counts, ridge 1
        p = 1 / (1 + np.exp(-x @ beta))
        w = n * p * (1 - p)
        beta += np.linalg.solve((x * w[:, None]).T @ x + np.eye(len(beta)), x.T @ (n * (post - p)) - beta)
    p = 1 / (1 + np.exp(-x @ beta))
    # A span needs one labeler's support besides the classifier's.
    return {int(c) for c, q, v in zip(codes, p, votes) if q >= 0.5 and (v == 1).any()}


def detect_pii(docs: DataFrame, key: str = "doc_id", text: str = "text", keep: tuple[str, ...] = ()) -> DataFrame:
    """key, n_email, n_ip, n_card, n_phone, base_sha256, found: array<struct<start,ord,kind,end,base>> (and kept columns).

    ``found`` holds base and accepted extra spans by start, then kind."""
    names = [key, *keep]
    kinds = [docs.schema[c].dataType.simpleString() for c in names]
    carried = [f"_row{i}" for i in range(len(names))]
    span = "struct<start:long,ord:int,kind:string,`end`:long,code:int>"
    schema = ", ".join([*(f"{c} {portable(k)}" for c, k in zip(carried, kinds)), "n_email long, n_ip long, n_card long, n_phone long, base_sha256 string",
                        f"spans array<{span}>"])

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for b in batches:
            rows = []
            for t in b["_pii_text"]:
                t = t or ""
                base = base_spans(t)
                n = [sum(k == i for _, k, _ in base) for i in range(4)]
                said = ",".join(f"{KINDS[k]}:{s}:{e}" for s, k, e in base)
                spans = [{"start": s, "ord": k, "kind": KINDS[k], "end": e, "code": -1} for s, k, e in base]
                spans += [{"start": s, "ord": 4 + k if EXTRA[k] not in KINDS else KINDS.index(EXTRA[k]), "kind": EXTRA[k], "end": e, "code": c}
                          for s, k, e, c in extra_candidates(t, base)]
                rows.append((*n, hashlib.sha256(said.encode()).hexdigest(), spans))
            out = pd.DataFrame(rows, columns=["n_email", "n_ip", "n_card", "n_phone", "base_sha256", "spans"])
            for i, c in enumerate(carried):
                out.insert(i, c, b[c].array)
            yield out

    rows = docs.select(*[F.col(n).cast(portable(k)).alias(c) for n, k, c in zip(names, kinds, carried)], F.col(text).alias("_pii_text"))
    spans = rows.mapInPandas(run, schema)
    first = materialise(spans.select(*[F.col(c).cast(k).alias(n) for n, k, c in zip(names, kinds, carried)], *spans.columns[len(names):]), "pii-spans")
    seen = first.select(F.explode("spans.code").alias("c")).where("c >= 0").groupBy("c").agg(F.count(F.lit(1)).alias("n"))
    accepted = fit_votes({r["c"]: r["n"] for r in seen.collect()})  # at most kinds * 27 * 4 feature codes
    ok = F.array(F.lit(-1), *[F.lit(c) for c in sorted(accepted)])
    found = F.array_sort(F.filter("spans", lambda s: F.array_contains(ok, s["code"])))
    return first.withColumn("found", found).drop("spans")
