"""Personal data: base patterns, and a skip-chain random field that makes a document consistent."""

from __future__ import annotations

import hashlib
import re
from bisect import bisect_right
from dataclasses import dataclass

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, functions as F
from pyspark.sql.types import StructType

from lexmill.llm.common import columns, map_rows, text_or_empty

# The kinds in their listed order and their patterns.
KINDS = ("email", "ip", "card", "phone")
LOCAL = frozenset("ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789._%+-")
DOMAIN = re.compile(r"[A-Za-z0-9-]+(?:\.[A-Za-z0-9-]+)+")
# A match can start inside a run of digits only if it can start at the run's first digit.
IP = re.compile(r"(?<![0-9])[0-9]+(?:\.[0-9]+){3}")
CARD = re.compile(r"[0-9](?:[\x20-]?[0-9])+")
PHONE = re.compile(r"\+[0-9][\x20().0-9-]+[0-9]")
HINT = re.compile(r"[0-9@]|[(\[{]at[)\]}]")

# Candidates beyond the base: runs of digits and separators, their parts, and spelled-out addresses. Those
# without brackets look like any words; they are candidates where the text has the same address elsewhere.
RUN = re.compile(r"[+(]?[0-9][0-9().\x20/+-]*[0-9]")
PART = re.compile(r"[^\x20]+")
FOURS = re.compile(r"[0-9]{4}(?:[\x20-][0-9]{4}){3}(?![0-9])")
SPELLED = re.compile(
    r"[A-Za-z0-9._%+-]+ ?[(\[{]at[)\]}] ?[A-Za-z0-9-]+(?: ?(?:\.|[(\[{]dot[)\]}]) ?[A-Za-z0-9-]+)+", re.I
)
LOOSE = re.compile(r"[A-Za-z0-9._%+-]+ at [A-Za-z0-9-]+(?: dot [A-Za-z0-9-]+)+", re.I)
CUES = {
    "phone": 3, "tel": 3, "telephone": 3, "call": 3, "fax": 3, "mobile": 3, "cell": 3,
    "card": 2, "visa": 2, "mastercard": 2, "credit": 2, "mail": 0, "email": 0, "e-mail": 0,
    "ip": 1, "host": 1, "server": 1,
}
N_FEATURES = 20
#: Labels: no personal data, then the kinds.
N_LABELS = 1 + len(KINDS)
#: Candidates at most so many characters apart are neighbours in the chain.
NEAR = 120
#: Digits that a local number shares with its full form, and digits of a number that may differ in one.
TAIL = 7
LONG_NUMBER = 10
#: Weight of a skip edge between similar data; between equal ones it is 1.
SIMILAR = 0.8

#: Bounds of the fitting sample: documents, and candidates of a document.
FIT_DOCS = 2_000
FIT_NODES = 64
#: A candidate is added when one kind has at least this probability.
CERTAIN = 0.9
ROUNDS = 40


def luhn(digits: str) -> bool:
    total = 0
    for k, d in enumerate(map(int, reversed(digits))):
        total += d if k % 2 == 0 else (2 * d if d < 5 else 2 * d - 9)
    return total % 10 == 0


def _emails(text: str):
    done, at = 0, text.find("@")
    while at >= 0:
        start = at
        while start > done and text[start - 1] in LOCAL:
            start -= 1
        found = DOMAIN.match(text, at + 1) if start < at else None
        if found:
            done = found.end()
            yield start, done
        at = text.find("@", max(at + 1, done))


def base_spans(text: str) -> list[tuple[int, int, int]]:
    """``(start, end, kind)`` of the base patterns, ordered by start, then kind."""
    if not HINT.search(text):
        return []
    spans = [(a, b, 0) for a, b in _emails(text)]
    for m in IP.finditer(text):
        if all(len(part.lstrip("0")) <= 3 and int(part.lstrip("0")[:4] or 0) <= 255 for part in m.group().split(".")):
            spans.append((m.start(), m.end(), 1))
    for m in CARD.finditer(text):
        if m.end() - m.start() <= 37:
            digits = m.group().replace(" ", "").replace("-", "")
            if 14 <= len(digits) <= 19 and luhn(digits):
                spans.append((m.start(), m.end(), 2))
    if "+" in text:
        for m in PHONE.finditer(text):
            if 10 <= sum(c.isdigit() for c in m.group()) <= 15:
                spans.append((m.start(), m.end(), 3))
    return sorted(spans)


@dataclass(frozen=True)
class Node:
    """A candidate: its span, the base's label (0: none) and the key that similar ones share."""

    start: int
    stop: int
    label: int
    key: str


def _key(piece: str, label: int) -> str:
    """Equal for spellings of one datum: bare digits without country code, or the plain address."""
    if label == 2:  # dotted numbers keep their parts
        return piece
    if LOOSE.fullmatch(piece):
        return re.sub(r" dot ", ".", re.sub(r" at ", "@", piece.lower(), count=1))
    if "@" in piece or SPELLED.fullmatch(piece):
        plain = re.sub(r" ?[(\[{]at[)\]}] ?", "@", piece.lower())
        return re.sub(r" ?[(\[{]dot[)\]}] ?", ".", plain).replace(" ", "")
    digits = re.sub(r"[^0-9]", "", piece)
    return digits[-10:] if 10 <= len(digits) <= 13 else digits


def nodes_of(text: str, base: list[tuple[int, int, int]]) -> list[Node]:
    """Base spans and looser candidates that touch none of them, by start."""
    found = [Node(a, b, k + 1, _key(text[a:b], k + 1)) for a, b, k in base]
    taken: list[list[int]] = []  # what base spans cover, by start
    for a, b, _ in base:
        if taken and a < taken[-1][1]:
            taken[-1][1] = max(b, taken[-1][1])
        else:
            taken.append([a, b])
    starts = [a for a, _ in taken]

    def free(a: int, b: int):
        """What base spans leave of a stretch of the text."""
        k = max(0, bisect_right(starts, a) - 1)
        while k < len(taken) and taken[k][0] < b:
            if taken[k][1] > a:
                if taken[k][0] > a:
                    yield a, taken[k][0]
                a = taken[k][1]
            k += 1
        if a < b:
            yield a, b

    for m in RUN.finditer(text):
        for a, b in free(*m.span()):
            spans = [m.span()] if (a, b) == m.span() else [r.span() for r in RUN.finditer(text, a, b)]
            for span in spans:
                found += [Node(c, d, 0, _key(text[c:d], 0)) for c, d in _numbers(text, *span)]
    if re.search(r"[(\[{]at[)\]}]", text, re.I):
        for m in SPELLED.finditer(text):
            if list(free(*m.span())) == [m.span()]:
                found.append(Node(*m.span(), 0, _key(m.group(), 0)))
    if " dot " in text.lower():
        known = {n.key for n in found if "@" in n.key}
        for m in LOOSE.finditer(text):
            if (key := _key(m.group(), 0)) in known and list(free(*m.span())) == [m.span()]:
                found.append(Node(*m.span(), 0, key))
    return sorted(found, key=lambda n: (n.start, n.stop, n.label))


def _numbers(text: str, a: int, b: int) -> list[tuple[int, int]]:
    """Candidates in a run of digits: all of it, or of a run too long for one datum its parts.

    Four groups of four digits are one candidate. Parts join their neighbours until these hold ``LONG_NUMBER``
    digits, but none that would make more than a phone number's 13.
    """
    whole = text[a:b]
    n = sum(c.isdigit() for c in whole)
    if n < 7:
        return []
    if n <= 15 and " " in whole or n <= 19 and " " not in whole:
        return [(a, b)]
    out, start, held = [], a, 0

    def flush(stop):
        nonlocal held
        if 7 <= held <= 19:
            out.append((start, stop))
        held = 0

    stop = a
    for p in PART.finditer(text, a, b):
        if p.start() < stop:
            continue  # inside four groups
        if card := FOURS.match(text, p.start(), b):
            flush(stop)
            out.append(card.span())
            stop = card.end()
            continue
        digits = sum(c.isdigit() for c in p.group())
        if held + digits > 13:
            flush(stop)
        start = start if held else p.start()
        held, stop = held + digits, p.end()
        if held >= LONG_NUMBER:
            flush(stop)
    flush(stop)
    return out


def features(text: str, node: Node) -> np.ndarray:
    """What a candidate looks like and the word before it."""
    piece = text[node.start : node.stop]
    digits = re.sub(r"[^0-9]", "", piece)
    n, f = len(digits), np.zeros(N_FEATURES)
    f[0] = 1
    f[1] = "@" in piece
    f[2] = bool(SPELLED.fullmatch(piece))
    for k, (low, high) in enumerate(((0, 6), (7, 9), (10, 13), (14, 15), (16, 16), (17, 19))):
        f[3 + k] = low <= n <= high
    f[9] = 14 <= n <= 19 and luhn(digits)
    f[10] = piece.startswith("+")
    f[11] = "(" in piece
    f[12] = "-" in piece
    f[13] = piece == digits
    parts = piece.split(".")
    f[14] = len(parts) == 4 and all(p.isdigit() and len(p) <= 3 and int(p) <= 255 for p in parts)
    before = re.findall(r"[A-Za-z-]+", text[max(0, node.start - 24) : node.start])
    cue = CUES.get(before[-1].lower()) if before else None
    if cue is not None:
        f[15 + cue] = 1
    f[19] = 10 <= n <= 15 and not f[13]
    return f


def edges_of(nodes: list[Node]) -> tuple[list[tuple[int, int]], list[tuple[int, int, float]]]:
    """Chain edges between near neighbours; weighted skip edges from each candidate to the last alike.

    Alike are equal keys, and with less weight numbers of equal last digits, one of them local, and long
    numbers that differ in one digit. Each candidate has at most four skip edges back.
    """
    chain = [(i, i + 1) for i in range(len(nodes) - 1) if nodes[i + 1].start - nodes[i].stop <= NEAR]
    last: dict[tuple, int] = {}
    skip = []
    for i, node in enumerate(nodes):
        key, digits = node.key, node.key.isdigit()
        marks = [("key", key)]
        if digits and TAIL <= len(key) <= LONG_NUMBER:
            marks.append(("tail", key[-TAIL:]))
        if digits and len(key) >= LONG_NUMBER:
            half = len(key) // 2
            marks += [("head", len(key), key[:half]), ("rest", len(key), key[half:])]
        linked = set()
        for mark in marks:
            j = last.get(mark)
            if j is not None and j not in linked:
                other = nodes[j].key
                if other == key:
                    weight = 1.0
                elif mark[0] == "tail":
                    weight = SIMILAR if min(len(key), len(other)) < LONG_NUMBER else 0.0
                else:
                    weight = SIMILAR if sum(x != y for x, y in zip(key, other)) == 1 else 0.0
                if weight:
                    linked.add(j)
                    skip.append((j, i, weight))
            last[mark] = i
    return chain, skip


@dataclass
class Field:
    """Weights: of features per label, of label pairs along the chain, of equal labels along skips of weight 1."""

    node: np.ndarray
    chain: np.ndarray
    skip: float

    @staticmethod
    def blank() -> Field:
        return Field(np.zeros((N_LABELS, N_FEATURES)), np.zeros((N_LABELS, N_LABELS)), 0.0)

    @staticmethod
    def fit(x: np.ndarray, label: np.ndarray, around: np.ndarray, alike: np.ndarray, steps: int = 400) -> Field:
        """Pseudo-likelihood: each label given its features and its neighbours' labels.

        ``around[i, l]`` counts chain neighbours with label ``l``, ``alike[i, l]`` skip neighbours of equal key.
        Half of the features are hidden in each step, so that a candidate which looks like
        nothing known learns to follow the candidates that share its key.
        """
        field = Field.blank()
        if not len(x):
            return field
        rng = np.random.default_rng(5)
        target = np.eye(N_LABELS)[label]
        for _ in range(steps):
            seen = x * (rng.random(x.shape) < 0.5)
            seen[:, 0] = 1
            score = seen @ field.node.T + around @ field.chain.T + field.skip * alike
            score -= score.max(axis=1, keepdims=True)
            p = np.exp(score)
            p /= p.sum(axis=1, keepdims=True)
            gap = (target - p) / len(x)
            field.node += 4 * (gap.T @ seen - 1e-4 * field.node)
            agree = gap.T @ around
            field.chain += 4 * ((agree + agree.T) / 2 - 1e-4 * field.chain)
            field.skip += 4 * float((gap * alike).sum() - 1e-4 * field.skip)
        field.skip = max(0.0, field.skip)
        return field

    def marginals(self, x: np.ndarray, known: np.ndarray, chain: list, skip: list) -> np.ndarray:
        """Label probabilities by loopy sum-product with damping; base labels are evidence."""
        local = x @ self.node.T
        fixed = known > 0
        local[fixed] = -50.0
        local[fixed, known[fixed]] = 0.0
        pairs = np.array([*chain, *((i, j) for i, j, _ in skip)], np.int64).reshape(-1, 2)
        if len(pairs):
            link = np.array([self.chain] * len(chain) + [self.skip * w * np.eye(N_LABELS) for _, _, w in skip])
            source = np.concatenate((pairs[:, 0], pairs[:, 1]))
            target = np.concatenate((pairs[:, 1], pairs[:, 0]))
            link = np.concatenate((link, link.transpose(0, 2, 1)))  # [edge, source label, target label]
            back = np.concatenate((np.arange(len(pairs)) + len(pairs), np.arange(len(pairs))))
            message = np.zeros((len(source), N_LABELS))
            for _ in range(ROUNDS):
                belief = local.copy()
                np.add.at(belief, target, message)
                out = (belief[source] - message[back])[:, :, None] + link
                top = out.max(axis=1, keepdims=True)
                new = (top + np.log(np.exp(out - top).sum(axis=1, keepdims=True)))[:, 0]
                new -= new.max(axis=1, keepdims=True)
                moved = np.abs(new - message).max()
                message = 0.5 * message + 0.5 * new
                if moved < 1e-4:
                    break
            np.add.at(local, target, message)
        local -= local.max(axis=1, keepdims=True)
        p = np.exp(local)
        return p / p.sum(axis=1, keepdims=True)


def all_spans(text: str, field: Field, base: list[tuple[int, int, int]] | None = None) -> list[tuple[int, int, int]]:
    """Base spans and the candidates that the field is certain of."""
    base = base_spans(text) if base is None else base
    if not HINT.search(text):
        return base
    nodes = nodes_of(text, base)
    if len(nodes) == len(base):
        return base
    x = np.array([features(text, n) for n in nodes])
    p = field.marginals(x, np.array([n.label for n in nodes]), *edges_of(nodes))
    added = [
        (n.start, n.stop, int(q[1:].argmax())) for n, q in zip(nodes, p) if not n.label and q[1:].max() >= CERTAIN
    ]
    return sorted(base + added)


def spelled(spans: list[tuple[int, int, int]]) -> str:
    return ",".join(f"{KINDS[k]}:{a}:{b}" for a, b, k in spans)


def redact(text: str, spans: list[tuple[int, int, int]]) -> str:
    """Each span, or run of overlapping spans, becomes the name of its first kind in brackets."""
    out, done = [], 0
    for a, b, k in spans:
        if a >= done:
            out.append(text[done:a] + f"[{KINDS[k].upper()}]")
        done = max(done, b)
    return "".join(out) + text[done:] if spans else text


EXAMPLES = columns(x="doubles", label="long", around="doubles", alike="doubles")


def examples_of(text: str) -> tuple[list, list, list, list]:
    """Of a text's first ``FIT_NODES`` candidates: features, base label, labels around, labels of equal keys.

    Edges between similar numbers take no part in the fit: the base patterns, whose labels these are, tell
    numbers apart by one digit.
    """
    nodes = nodes_of(text, base_spans(text))[:FIT_NODES]
    around, alike = np.zeros((2, len(nodes), N_LABELS))
    chain, skip = edges_of(nodes)
    for counts, pairs in ((around, chain), (alike, [(i, j) for i, j, weight in skip if weight == 1])):
        for i, j in pairs:
            counts[i, nodes[j].label] += 1
            counts[j, nodes[i].label] += 1
    return [features(text, n).tolist() for n in nodes], [n.label for n in nodes], around.tolist(), alike.tolist()


def fit_field(docs: DataFrame, text_col: str = "text", fit_docs: int = FIT_DOCS) -> Field:
    """The field, fitted to about ``fit_docs`` documents with digits or addresses, chosen by hash.

    The labels are those of the base patterns. At most twice ``fit_docs`` documents and
    ``FIT_NODES`` candidates of each come to the driver, as features. Without any, the weights are
    zero and only base spans are found.
    """
    hinted = docs.select(text_or_empty(text_col).alias("body")).where(F.col("body").rlike("[0-9@]|[(\\[{]at[)\\]}]"))
    total = hinted.count()
    part = F.pmod(F.xxhash64("body"), F.lit(1 << 20))
    sample = hinted.where(part <= int(min(1.0, fit_docs / max(1, total)) * (1 << 20))).limit(2 * fit_docs)

    def make():
        def apply(texts):
            parts = [examples_of(text) for text in texts]
            out = {name: [v for part in parts for v in part[k]] for k, name in enumerate(EXAMPLES.fieldNames())}
            return out

        return apply

    rows = sorted(map_rows(sample, EXAMPLES, make).collect())
    if not rows:
        return Field.blank()
    return Field.fit(*(np.array([r[k] for r in rows]) for k in range(4)))


def find_private_data(
    docs: DataFrame, field: Field | None = None, id_col: str = "doc_id", text_col: str = "text", redacted: bool = False
) -> DataFrame:
    """One row per input row: ``id_col``, the counts ``n_email`` to ``n_phone`` of base spans,
    ``n_added``, ``base_sha256``, ``spans`` and, on request, ``redacted``, the text with names for its spans.

    Spans are ``kind:start:end`` in code points, by start and then kind. Base spans always stay;
    the field, fitted to ``docs`` if none is given, adds candidates. A null text is the empty text;
    ids may be null or repeated; whole texts are read, in time that follows their length. Other
    columns are not read.
    """
    field = fit_field(docs, text_col) if field is None else field
    source = docs.select(F.col(id_col).alias("row_id"), text_or_empty(text_col).alias("body"))
    out = columns(
        n_email="long", n_ip="long", n_card="long", n_phone="long", n_added="long",
        base_sha256="string", spans="string", **({"redacted": "string"} if redacted else {}),
    )
    schema = StructType([source.schema["row_id"], *out.fields])

    def make():
        def apply(ids, texts):
            rows = []
            for text in texts:
                base = base_spans(text)
                every = all_spans(text, field, base)
                counts = [sum(k == kind for _, _, k in base) for kind in range(len(KINDS))]
                digest = hashlib.sha256(spelled(base).encode()).hexdigest()
                row = (*counts, len(every) - len(base), digest, spelled(every))
                rows.append((*row, redact(text, every)) if redacted else row)
            return {"row_id": ids} | dict(zip(out.fieldNames(), zip(*rows)))

        return apply

    return map_rows(source, schema, make).withColumnRenamed("row_id", id_col)


def redact_documents(docs: DataFrame, field: Field | None = None, text_col: str = "text") -> DataFrame:
    """``docs`` with the names of the kinds in place of personal data; other columns and null texts stay."""
    field = fit_field(docs, text_col) if field is None else field

    @F.pandas_udf("string")
    def cleaned(texts: pd.Series) -> pd.Series:
        return texts.map(lambda t: redact(t, all_spans(t, field)), na_action="ignore")

    return docs.withColumn(text_col, cleaned(F.col(text_col)))
