"""Personal data by weak supervision: labelers vote, EM weighs them, a classifier decides.

Base spans (email, ip, card, phone) are found by fixed patterns and checks and
always stay.  Further candidates are what the patterns nearly found: card-shaped
numbers without a valid check digit, addresses with parts above 255, telephone
numbers without a plus, spelled-out email addresses and assigned secrets.  Every
candidate, base ones included, gets votes (for, against, none) from a pattern
labeler, a gazetteer labeler, a context labeler, a shape labeler and a variety
labeler.  Expectation-maximisation over the counts of all vote patterns of the
corpus estimates, for each kind, how far each labeler can be trusted; a logistic
classifier of the span's kind, votes and form is then trained on the posteriors
of all candidates, and spans with at least even odds are added.

One pass over the texts finds spans and codes; what reaches the driver is a count
for each code, at most ``CODES`` of them whatever the size of the corpus.

Defined cases: a null or empty text has no spans; every row gives one row; ids may
be null or repeated; an empty table trains nothing and gives no rows.  The texts
are searched whole, in time linear in their length.
"""

from __future__ import annotations

import re
from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from variantloom.llm.common import Stored

KINDS = ("email", "ip", "card", "phone", "secret")
LABELERS = ("pattern", "gazetteer", "context", "shape", "variety")
NONE, FOR, AGAINST = 0, 1, 2
# Weight of what is believed of a labeler beforehand, as a share of the candidates of a kind:
# patterns with a check digit or a range check are trusted more than hints.
TRUST = (2.0, 0.1, 0.1, 0.1, 0.1)
FORMS = 16
CODES = len(KINDS) * 3 ** len(LABELERS) * FORMS

_LOCAL = frozenset("ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789._%+-")
_DOMAIN = re.compile(r"[A-Za-z0-9-]++(?:\.[A-Za-z0-9-]++)++")
# A number cannot be entered in its middle: what fails at its start fails at every later digit.
_IP = re.compile(r"(?<![0-9])[0-9]++\.[0-9]++\.[0-9]++\.[0-9]++")
_CARD = re.compile(r"[0-9](?:[\x20-]?[0-9])++")
_PHONE = re.compile(r"\+[0-9][\x20().0-9-]+[0-9]")
_DIGIT = re.compile(r"[0-9]")
_PLAIN_PHONE = re.compile(r"(?<![0-9+])\(?[0-9]{3}\)?[ .-][0-9]{3}[.-][0-9]{4}(?![0-9])")
_SPELLED = re.compile(r"(?<![A-Za-z0-9._%+-])[A-Za-z0-9._%+-]{1,64} ?[\[(]at[\])] ?[A-Za-z0-9-]{1,63}(?: ?[\[(]dot[\])] ?[A-Za-z0-9-]{1,63})+", re.IGNORECASE)
_SECRET = re.compile(r"(?:token|secret|password|passwd|api_?key)\s{0,3}[=:]\s{0,3}[\"']?([A-Za-z0-9_+/-]{16,}+)", re.IGNORECASE)

# Fixed values of the gazetteers and the context lists.
TOP_DOMAINS = frozenset("com org net edu gov info io co de fr es uk eu us ca ch at it nl".split())
CALLING_CODES = ("1", "20", "27", "30", "31", "32", "33", "34", "39", "41", "43", "44", "45", "46", "47", "48", "49", "52", "54", "55", "61", "81", "82", "86", "91")
CARD_PREFIXES = ("4", "51", "52", "53", "54", "55", "34", "37", "6011", "65", "35", "30", "36", "38")
RESERVED_NETS = ("0.", "127.", "255.", "224.", "169.254.")
CUES = {
    "email": "email mail contact write address correo courriel".split(),
    "ip": "ip host server address addr client".split(),
    "card": "card visa mastercard amex credit payment pay tarjeta carte karte".split(),
    "phone": "call phone tel telephone mobile fax cell dial".split(),
    "secret": "token secret password passwd api key apikey api_key".split(),
}
COUNTER_CUES = "order invoice isbn issn version section chapter article serial ticket".split()


def luhn(digits: str) -> bool:
    total = 0
    for place, digit in enumerate(map(int, reversed(digits))):
        doubled = digit * 2 if place % 2 else digit
        total += doubled - 9 if doubled > 9 else doubled
    return total % 10 == 0


def emails(text: str) -> list[tuple[int, int]]:
    """From sign to sign: the longest local part that no earlier match has taken, then the domain."""
    found, free, at = [], 0, text.find("@")
    while at >= 0:
        start = at
        while start > free and text[start - 1] in _LOCAL:
            start -= 1
        domain = _DOMAIN.match(text, at + 1) if start < at else None
        free = domain.end() if domain else at + 1
        if domain:
            found.append((start, free))
        at = text.find("@", free)
    return found


def _digits(s: str) -> str:
    return "".join(c for c in s if "0" <= c <= "9")


def find_spans(text: str) -> list[tuple[int, int, int, bool]]:
    """(kind, start, end, base) of base spans and further candidates, in order."""
    spans = [(0, a, b, True) for a, b in emails(text)]
    near = []
    if first := _DIGIT.search(text):
        at = first.start()
        for m in _IP.finditer(text, at):
            good = all(len(p.lstrip("0")) <= 3 and int(p.lstrip("0") or "0") <= 255 for p in m[0].split("."))
            (spans if good else near).append((1, *m.span(), good))
        for m in _CARD.finditer(text, at):
            digits = _digits(m[0])
            if 13 <= len(digits) <= 19:
                good = luhn(digits)
                (spans if good else near).append((2, *m.span(), good))
        for m in _PHONE.finditer(text, max(at - 1, 0)):
            if 9 <= len(_digits(m[0])) <= 15:
                spans.append((3, *m.span(), True))
        near += [(3, *m.span(), False) for m in _PLAIN_PHONE.finditer(text, max(at - 1, 0))]
    if "=" in text or ":" in text:
        near += [(4, *m.span(1), False) for m in _SECRET.finditer(text)]
    if "at)" in (low := text.lower()) or "at]" in low:
        near += [(0, *m.span(), False) for m in _SPELLED.finditer(text)]
    taken = sorted((a, b) for _, a, b, _ in spans)
    starts = [a for a, _ in taken]
    for kind, a, b, _ in near:
        at = int(np.searchsorted(starts, b))  # bases that begin before the end
        if not any(y > a for _, y in taken[max(0, at - 4) : at]):
            spans.append((kind, a, b, False))
    return sorted(spans)


def votes(text: str, kind: int, start: int, end: int, base: bool) -> tuple[int, ...]:
    """One vote of each labeler on a candidate."""
    span = text[start:end]
    digits = _digits(span)
    name = KINDS[kind]
    before = re.findall(r"[a-z_]+", text[max(0, start - 48) : start].lower())[-4:]
    pattern = FOR if base else AGAINST if kind in (1, 2) else NONE
    if kind == 0:
        known = FOR if span.rsplit(".", 1)[-1].lower() in TOP_DOMAINS else NONE
    elif kind == 1:
        known = AGAINST if span.startswith(RESERVED_NETS) else NONE
    elif kind == 2:
        known = FOR if digits.startswith(CARD_PREFIXES) else AGAINST
    elif kind == 3:
        known = FOR if digits.startswith(CALLING_CODES) and span[0] == "+" else NONE
    else:
        known = FOR if re.fullmatch(r"[0-9a-f]{32,}", span) else NONE
    context = FOR if set(before) & set(CUES[name]) else AGAINST if set(before) & set(COUNTER_CUES) else NONE
    if kind == 2:
        shape = FOR if len(digits) == 16 else AGAINST if len(digits) in (17, 18) else NONE
    elif kind == 3:
        shape = FOR if re.search(r"[ ().-]", span) else NONE
    elif kind == 4:
        shape = FOR if any(c.isdigit() for c in span) and any(c.isalpha() for c in span) else AGAINST
    else:
        shape = FOR if len(span) <= 64 else AGAINST
    variety = AGAINST if len(set(digits or span)) <= 2 else FOR if len(set(digits or span)) >= 5 else NONE
    return pattern, known, context, shape, variety


def form(text: str, start: int, end: int) -> int:
    """Four bits on the span's form: long, has blanks, free on the left, free on the right."""
    free = lambda i: not (0 <= i < len(text)) or not text[i].isalnum()
    return (end - start > 20) + 2 * any(c in " ()" for c in text[start:end]) + 4 * free(start - 1) + 8 * free(end)


def code_of(kind: int, vote: tuple[int, ...], shape: int) -> int:
    code = kind
    for v in vote:
        code = code * 3 + v
    return code * FORMS + shape


def decode(code: int) -> tuple[int, list[int], int]:
    code, shape = divmod(code, FORMS)
    vote = []
    for _ in LABELERS:
        code, v = divmod(code, 3)
        vote.append(v)
    return code, vote[::-1], shape


def estimate_labels(codes: np.ndarray, counts: np.ndarray, rounds: int = 50) -> np.ndarray:
    """Posterior of each code being personal data: two-class EM over vote counts, kind by kind.

    The pseudo-counts say that labelers are more often right than wrong; they keep
    the classes from changing places and decide where a kind has few candidates.
    """
    if not len(codes):
        return np.zeros(0)
    parts = [decode(int(c)) for c in codes]
    kind = np.array([p[0] for p in parts])
    vote = np.array([p[1] for p in parts])
    believe = np.array([[[2.0, 6.0, 1.0], [2.0, 1.0, 6.0]]] * len(LABELERS))  # of a true span, of a false one: none, for, against
    believe[0] = [[4.0, 4.9, 0.1], [3.0, 1.0, 5.0]]  # a failed check is hardly ever a true span
    out = np.zeros(len(codes))
    for k in np.unique(kind):
        at = kind == k
        v, n = vote[at], counts[at].astype(float)
        score = (v == FOR).sum(1) - (v == AGAINST).sum(1)
        post = 1 / (1 + np.exp(-score.astype(float)))
        for _ in range(rounds):
            prior = np.array([((1 - post) * n).sum() + 1, (post * n).sum() + 1])
            log = np.log(prior / prior.sum())[::-1][None, :].repeat(len(v), 0)  # true, false
            for j in range(v.shape[1]):
                seen = np.stack([np.bincount(v[:, j], w * n, 3) for w in (post, 1 - post)])
                seen = seen + believe[j] * max(1.0, TRUST[j] * n.sum() / believe[j].sum())
                log += np.log(seen / seen.sum(1, keepdims=True))[:, v[:, j]].T
            post = 1 / (1 + np.exp(np.clip(log[:, 1] - log[:, 0], -50, 50)))
        out[at] = post
    return out


def features(codes: np.ndarray) -> np.ndarray:
    """Kind, kind by vote of each labeler, and the form bits, one column each."""
    rows = np.zeros((len(codes), 1 + len(KINDS) + len(KINDS) * len(LABELERS) * 3 + 4))
    for i, c in enumerate(codes):
        kind, vote, shape = decode(int(c))
        rows[i, 0] = rows[i, 1 + kind] = 1
        for j, v in enumerate(vote):
            rows[i, 1 + len(KINDS) + (kind * len(LABELERS) + j) * 3 + v] = 1
        rows[i, -4:] = [shape >> b & 1 for b in range(4)]
    return rows


def train_classifier(codes: np.ndarray, counts: np.ndarray, posterior: np.ndarray, steps: int = 300) -> np.ndarray:
    """Weights of a logistic classifier of spans, by Newton steps on the posteriors."""
    x = features(codes)
    w = np.zeros(x.shape[1])
    if not len(codes):
        return w
    n = counts / counts.sum()
    ridge = 1e-3 * np.eye(x.shape[1])
    for _ in range(min(steps, 30)):
        p = 1 / (1 + np.exp(-np.clip(x @ w, -30, 30)))
        gradient = x.T @ (n * (p - posterior)) + ridge @ w
        curve = (x * (n * np.maximum(p * (1 - p), 1e-6))[:, None]).T @ x + ridge
        w -= np.linalg.solve(curve, gradient)
    return w


def probability(codes: np.ndarray, weights: np.ndarray) -> np.ndarray:
    return 1 / (1 + np.exp(-np.clip(features(codes) @ weights, -30, 30)))


SPANS = "array<struct<kind:int,start:int,end:int,base:boolean,code:int>>"


def candidates(docs: DataFrame, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """(id, found): base spans and candidates of every whole text, with their codes."""

    def search(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            found = []
            for body in batch["body"]:
                rows = find_spans(body) if body else []
                found.append([{"kind": k, "start": a, "end": b, "base": base, "code": code_of(k, votes(body, k, a, b, base), form(body, a, b))} for k, a, b, base in rows])
            yield pd.DataFrame({"id": batch["id"], "found": found})

    kind = docs.schema[doc_id].dataType.simpleString()
    return docs.select(docs[doc_id].alias("id"), docs[text].alias("body")).mapInPandas(search, f"id {kind}, found {SPANS}")


def detect(docs: DataFrame, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """(id, found): the base spans, and the candidates that the trained classifier accepts."""
    found = Stored(candidates(docs, doc_id, text)).frame
    seen = found.select(F.explode("found.code").alias("code")).groupBy("code").count().toPandas()
    codes, counts = seen["code"].to_numpy(np.int64), seen["count"].to_numpy(np.int64)
    order = np.argsort(codes)
    codes, counts = codes[order], counts[order]
    weights = train_classifier(codes, counts, estimate_labels(codes, counts))
    accepted = [int(c) for c in codes[probability(codes, weights) >= 0.5]] if len(codes) else []
    return found.select("id", F.filter("found", lambda s: s["base"] | s["code"].isin(accepted)).alias("found"))


def span_texts(found: DataFrame) -> DataFrame:
    """(id, counts of base spans, base, spans): spans as ``kind:start:end``, by kind, then start."""
    names = F.array(*(F.lit(k) for k in KINDS))
    text = lambda spans: F.array_join(F.transform(spans, lambda s: F.concat_ws(":", F.get(names, s["kind"]), s["start"].cast("string"), s["end"].cast("string"))), ",")
    base = F.filter("found", lambda s: s["base"])
    kinds = F.transform(base, lambda s: s["kind"])
    counts = [(F.size(base) - F.size(F.array_remove(kinds, k))).cast("long").alias(f"n_{name}") for k, name in enumerate(KINDS[:4])]
    return found.select("id", *counts, text(base).alias("base"), text(F.col("found")).alias("spans"))
