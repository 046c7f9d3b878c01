"""Personal data: plain patterns, and a semi-Markov conditional random field beside them.

The patterns give spans that always stay. The field looks at regions that could hold an
entity (around digits and at-signs): it scores whole candidate segments of a region by
features of the segment as a whole, and dynamic programming over segments of bounded length
chooses boundaries and kinds of a region together. What it finds away from the patterns' spans
is added. It is trained on regions of the corpus, whose labels are the patterns' spans.
"""

from __future__ import annotations

import re
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ledgerline.llm.common import in_slices, table, texts, written

KINDS = ("email", "ip", "card", "phone")
# The field is fitted on at most so many regions of different shape, none longer than that.
FIT_REGIONS = 800
FIT_CHARS = 120
# An entity has at most so many tokens (runs of digits or letters, single other signs).
ENTITY = 24
# Chance above which a segment the field chooses is added.
SURE = 0.9

_LOCAL = frozenset("ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789._%+-")
_DOMAIN = re.compile(r"[A-Za-z0-9-]+(?:\.[A-Za-z0-9-]+)+")
# A match starts where a run of digits starts: from inside a run nothing else can follow.
_IP = re.compile(r"(?<![0-9])[0-9]++(?:\.[0-9]++){3}")
_CARD = re.compile(r"[0-9](?:[ -]?[0-9])+")
_PHONE = re.compile(r"\+[0-9][ ().0-9-]+[0-9]")
_NUMERIC = re.compile(r"[+(]?[0-9][0-9().\x20+-]*")
_TOKEN = re.compile(r"[0-9]+|[A-Za-z]+|[^0-9A-Za-z]")
_DIGIT = re.compile("[0-9]")


def luhn(digits: str) -> bool:
    """Whether the check digit fits."""
    total = 0
    for i, d in enumerate(reversed(digits)):
        n = ord(d) - 48
        if i % 2:
            n = 2 * n - 9 if n > 4 else 2 * n
        total += n
    return total % 10 == 0


def _emails(text: str) -> list[tuple[int, int]]:
    """Leftmost matches of the address pattern, from at-sign to at-sign."""
    found, free, at = [], 0, text.find("@")
    while at >= 0:
        low = at
        while low > free and text[low - 1] in _LOCAL:
            low -= 1
        domain = _DOMAIN.match(text, at + 1) if low < at else None
        if domain:
            found.append((low, domain.end()))
            free = domain.end()
        at = text.find("@", max(at + 1, free))
    return found


def base_spans(text: str) -> list[tuple[int, int, int]]:
    """(kind, start, end) of the pattern matches that pass their check, by kind and start."""
    spans = [(0, a, b) for a, b in _emails(text)] if "@" in text else []
    if not _DIGIT.search(text):
        return spans
    if "." in text:
        spans += [(1, *m.span()) for m in _IP.finditer(text) if all(len(p.lstrip("0")) <= 3 and int(p.lstrip("0") or "0") <= 255 for p in m.group().split("."))]
    for m in _CARD.finditer(text):
        if m.end() - m.start() >= 13:
            digits = m.group().replace(" ", "").replace("-", "")
            if 13 <= len(digits) <= 19 and luhn(digits):
                spans.append((2, *m.span()))
    if "+" in text:
        for m in _PHONE.finditer(text):
            if 9 <= len(_DIGIT.findall(m.group())) <= 15:
                spans.append((3, *m.span()))
    return spans


def regions(text: str) -> list[tuple[int, int]]:
    """Stretches that could hold an entity: runs of at least four digits with their signs, at-signs with their words."""
    found = []
    for m in _NUMERIC.finditer(text):
        end = m.end()
        while not "0" <= text[end - 1] <= "9":
            end -= 1
        if end - m.start() >= 4 and len(_DIGIT.findall(text, m.start(), end)) >= 4:
            found.append((m.start(), end))
    at = text.find("@")
    while at >= 0:
        low, high = at, at + 1
        while low > 0 and at - low < 64 and not text[low - 1].isspace():
            low -= 1
        while high < len(text) and high - at < 255 and not text[high].isspace():
            high += 1
        found.append((low, high))
        at = text.find("@", high)
    return found


FEATURES = 30


def features(region: str, tokens: list[tuple[int, int]], i: int, j: int, left: str, right: str) -> list[int]:
    """Features that hold for the segment of tokens i..j-1 as a whole."""
    start, end = tokens[i][0], tokens[j - 1][1]
    part = region[start:end]
    groups = re.findall("[0-9]+", part)
    digits = "".join(groups)
    n = len(digits)
    signs = set(part) - set("0123456789")
    before = region[start - 1] if start else left[-1:]
    after = region[end] if end < len(region) else right[:1]
    on = [0]
    if "@" in part:
        on.append(1)
        if "." in part.partition("@")[2]:
            on.append(2)
    else:
        on.append(3 if n < 4 else 4 if n < 9 else 5 if n < 13 else 6 if n < 16 else 7 if n == 16 else 8 if n < 20 else 9)
    if part[0] == "+":
        on.append(10)
    if "(" in signs and ")" in signs:
        on.append(11)
    if signs == {"."}:
        on.append(12)
        if len(groups) == 4 and all(len(g) <= 3 and int(g) <= 255 for g in groups):
            on.append(13)
    if 13 <= n <= 19 and signs <= set(" -"):
        on.append(14 if luhn(digits) else 15)
    if not signs:
        on.append(16)
    elif signs <= set(" -"):
        on.append(17)
        if all(len(g) == 4 for g in groups):
            on.append(18)
    if groups and len(groups[-1]) == 4:
        on.append(19)
    if any(len(g) == 3 for g in groups):
        on.append(20)
    if before.isalnum():
        on.append(21)
    if after.isalnum():
        on.append(22)
    if before and before in "+.-(":
        on.append(23)
    if after and after in ".-)":
        on.append(24)
    on.append(25 if len(groups) == 1 else 26 if len(groups) < 5 else 27)
    if any(x in signs for x in "/:=#"):
        on.append(28)
    if part[0] in ".-) " or part[-1] in ".-( +":
        on.append(29)
    return on


def _segments(region: str, left: str, right: str) -> tuple[int, list[tuple[int, int, list[int]]]]:
    """Number of tokens; candidate segments (first token, end, features) of bounded length."""
    tokens = [m.span() for m in _TOKEN.finditer(region)]
    mail = "@" in region
    found = []
    for i in range(len(tokens)):
        first = region[tokens[i][0]]
        if not (first.isalnum() or first in "+(_%"):
            continue
        digits = 0
        for j in range(i + 1, min(len(tokens), i + ENTITY) + 1):
            a, b = tokens[j - 1]
            if region[a].isdigit():
                digits += b - a
            if digits > 19 and not mail:
                break
            if region[b - 1].isalnum() and (digits >= 4 or mail):
                found.append((i, j, features(region, tokens, i, j, left, right)))
    return len(tokens), found


@dataclass(frozen=True)
class Field:
    """Weights [kind, feature]; a token outside entities scores 0."""

    weights: np.ndarray

    def _scores(self, found: list) -> np.ndarray:
        return np.array([self.weights[:, on].sum(1) for _, _, on in found]) if found else np.zeros((0, len(KINDS)))

    def marginals(self, size: int, found: list) -> tuple[float, np.ndarray, np.ndarray]:
        """log Z, chance of each (segment, kind), and the scores."""
        scores = self._scores(found)
        forward, backward = np.full(size + 1, -np.inf), np.full(size + 1, -np.inf)
        forward[0] = backward[size] = 0.0
        mass = np.logaddexp.reduce(scores, axis=1) if found else np.zeros(0)
        by_end: list[list[int]] = [[] for _ in range(size + 1)]
        by_start: list[list[int]] = [[] for _ in range(size + 1)]
        for x, (i, j, _) in enumerate(found):
            by_end[j].append(x)
            by_start[i].append(x)
        for t in range(1, size + 1):
            forward[t] = np.logaddexp.reduce([forward[t - 1], *(forward[found[x][0]] + mass[x] for x in by_end[t])])
        for t in range(size - 1, -1, -1):
            backward[t] = np.logaddexp.reduce([backward[t + 1], *(backward[found[x][1]] + mass[x] for x in by_start[t])])
        ends = np.array([forward[i] + backward[j] for i, j, _ in found]) if found else np.zeros(0)
        return float(forward[size]), np.exp(np.minimum(scores + ends[:, None] - forward[size], 0.0)), scores

    def best(self, size: int, found: list) -> list[tuple[int, int]]:
        """(segment, kind) of the best reading: boundaries and kinds together."""
        scores = self._scores(found)
        top = scores.max(1) if found else np.zeros(0)
        by_end: list[list[int]] = [[] for _ in range(size + 1)]
        for x, (_, j, _) in enumerate(found):
            by_end[j].append(x)
        value, back = np.zeros(size + 1), [-1] * (size + 1)
        for t in range(1, size + 1):
            value[t] = value[t - 1]
            for x in by_end[t]:
                if value[found[x][0]] + top[x] > value[t]:
                    value[t], back[t] = value[found[x][0]] + top[x], x
        chosen, t = [], size
        while t > 0:
            if back[t] < 0:
                t -= 1
            else:
                chosen.append((back[t], int(scores[back[t]].argmax())))
                t = found[back[t]][0]
        return chosen[::-1]


def fit(rows: list[tuple[str, str, str, list[tuple[int, int, int]]]], rounds: int = 20, rate: float = 0.3) -> Field:
    """Field from (region, left, right, [(kind, start, end)]) rows by stochastic gradient ascent.

    Rows are taken in a fixed order. Of a phone number with country code the rest alone is a
    second example: people write numbers without it. No rows give a field that finds nothing.
    """
    examples = []
    for region, left, right, gold in rows:
        variants = [(region, gold)]
        for kind, a, b in gold:
            local = re.match(r"\+[0-9]{1,3}[ -]", region[a:b])
            if kind == 3 and local:
                variants.append((region[a + local.end():b], [(3, 0, b - a - local.end())]))
        for part, spans in variants:
            size, found = _segments(part, left, right)
            tokens = [m.span() for m in _TOKEN.finditer(part)]
            wanted = {(a, b): kind for kind, a, b in spans}
            gold_at = {x: wanted[(tokens[i][0], tokens[j - 1][1])] for x, (i, j, _) in enumerate(found) if (tokens[i][0], tokens[j - 1][1]) in wanted}
            if found:
                examples.append((size, found, gold_at))
    weights = np.zeros((len(KINDS), FEATURES))
    weights[:, 0] = -4.0
    total, steps = np.zeros_like(weights), 0
    for turn in range(rounds):
        for size, found, gold_at in examples:
            _, chance, _ = Field(weights).marginals(size, found)
            step = rate / (1 + turn / 4)
            for x, (_, _, on) in enumerate(found):
                change = -chance[x]
                if x in gold_at:
                    change = change.copy()
                    change[gold_at[x]] += 1.0
                if np.abs(change).max() > 1e-4:
                    weights[:, on] += step * change[:, None]
            weights *= 1 - 1e-4 * step
        if turn >= rounds // 2:
            total += weights
            steps += 1
    return Field(total / steps if examples else weights)


def added_spans(field: Field, start: int, region: str, left: str, right: str, base: list[tuple[int, int, int]]) -> list[tuple[int, int, int]]:
    """(kind, start, end) in the text of what the field chooses, sure, and away from all base spans."""
    size, found = _segments(region, left, right)
    if not found:
        return []
    chosen = field.best(size, found)
    if not chosen:
        return []
    _, chance, _ = field.marginals(size, found)
    tokens = [m.span() for m in _TOKEN.finditer(region)]
    out = []
    for x, kind in chosen:
        a, b = start + tokens[found[x][0]][0], start + tokens[found[x][1] - 1][1]
        if chance[x, kind] >= SURE and not any(a < e and s < b for _, s, e in base):
            out.append((kind, a, b))
    return out


_BASE = "array<struct<kind: int, start: int, end: int>>"
_SPAN = pa.list_(pa.struct([("kind", pa.int32()), ("start", pa.int32()), ("end", pa.int32())]))
_REGIONS = "array<struct<start: int, text: string, left: string, right: string>>"
_REGION = pa.list_(pa.struct([("start", pa.int32()), ("text", pa.string()), ("left", pa.string()), ("right", pa.string())]))


def _as_structs(spans: list[tuple[int, int, int]]) -> list[dict]:
    return [{"kind": k, "start": a, "end": b} for k, a, b in spans]


def _scan(found: list[str]) -> tuple[list, list]:
    """Base spans and regions of each text."""
    bases, around = [], []
    for text in found:
        base = base_spans(text)
        bases.append(_as_structs(base))
        around.append([
            {"start": a, "text": text[a:b], "left": text[max(0, a - 16):a], "right": text[b:b + 8]} for a, b in regions(text)
        ])
    return bases, around


def scan(documents: DataFrame) -> DataFrame:
    """doc_id, base spans and regions of every row: all that is needed of the texts later."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in in_slices(batches):
            bases, around = _scan(texts(batch))
            yield pa.RecordBatch.from_arrays(
                [batch.column("doc_id"), pa.array(bases, _SPAN), pa.array(around, _REGION)], names=["doc_id", "base", "regions"]
            )

    plain = documents.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text"))
    return plain.mapInArrow(run, f"doc_id long, base {_BASE}, regions {_REGIONS}")


def field_of(scanned: DataFrame) -> Field:
    """The field fitted on regions of different shape, chosen by a hash of the shape.

    Digits count as one letter in a shape, so common shapes are seen once; at most FIT_REGIONS
    short regions reach the driver.
    """
    schema = f"shape string, text string, left string, right string, base {_BASE}"

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            rows: dict[str, tuple] = {}
            for base, around in zip(batch.column("base").to_pylist(), batch.column("regions").to_pylist()):
                for r in around:
                    if len(r["text"]) > FIT_CHARS:
                        continue
                    low, high = r["start"], r["start"] + len(r["text"])
                    gold = [{"kind": s["kind"], "start": s["start"] - low, "end": s["end"] - low} for s in base if low <= s["start"] and s["end"] <= high]
                    shape = re.sub("[A-Za-z]+", "a", re.sub("[0-9]", "9", r["text"])) + str(sorted((s["kind"], s["start"], s["end"]) for s in gold))
                    rows.setdefault(shape, (shape, r["text"], r["left"], r["right"], gold))
            if rows:
                columns = list(zip(*rows.values()))
                yield pa.RecordBatch.from_arrays(
                    [*(pa.array(c, pa.string()) for c in columns[:4]), pa.array(columns[4], _SPAN)], names=["shape", "text", "left", "right", "base"]
                )

    each = scanned.select("base", "regions").filter(F.size("regions") > 0).mapInArrow(run, schema)
    one = each.groupBy("shape").agg(F.min(F.struct("text", "left", "right", "base")).alias("r"))
    chosen = one.orderBy(F.xxhash64("shape"), "shape").limit(FIT_REGIONS).collect()
    return fit([(x.r.text, x.r.left, x.r.right, [(s.kind, s.start, s.end) for s in x.r.base]) for x in sorted(chosen, key=lambda x: x.shape)])


def personal_data(documents: DataFrame) -> DataFrame:
    """doc_id, base, spans of every row: the patterns' spans, and those with the field's added.

    Spans count code points, end exclusive, and are ordered by kind (as in KINDS) and start.
    NULL text is empty text and has none; texts are searched whole, however long; repeated rows are
    searched each; a missing doc_id stays NULL; extra columns are not read. An empty table gives
    no rows.
    """
    scanned = written(scan(documents), "regions")
    field = field_of(scanned)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            spans = []
            for base, around in zip(batch.column("base").to_pylist(), batch.column("regions").to_pylist()):
                own = [(s["kind"], s["start"], s["end"]) for s in base]
                more = [x for r in around for x in added_spans(field, r["start"], r["text"], r["left"], r["right"], own)]
                spans.append(_as_structs(sorted({*own, *more})))
            yield pa.RecordBatch.from_arrays(
                [batch.column("doc_id"), batch.column("base"), pa.array(spans, _SPAN)], names=["doc_id", "base", "spans"]
            )

    return scanned.mapInArrow(run, f"doc_id long, base {_BASE}, spans {_BASE}")


def masked(text: str, spans: list[tuple[int, int, int]]) -> str:
    """The text with every span replaced by its kind in brackets; overlapping spans by the first's."""
    parts, at = [], 0
    for a, b, kind in sorted((a, -b, kind) for kind, a, b in spans):
        b = -b
        if a >= at:
            parts += [text[at:a], f"[{KINDS[kind].upper()}]"]
        at = max(at, b)
    return "".join([*parts, text[at:]])


def mask(documents: DataFrame, field: Field) -> DataFrame:
    """All rows with all columns; personal data in text masked, n_chars (if there) the new length.

    NULL text stays NULL; repeated rows and rows without doc_id are masked each; texts are masked
    whole, however long. An empty table gives no rows.
    """
    count = next((f.name for f in documents.schema.fields if f.name == "n_chars" and isinstance(f.dataType, (T.LongType, T.IntegerType))), None)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in in_slices(batches):
            old = batch.column("text").to_pylist()
            new = []
            for text in old:
                own = base_spans(text) if text else []
                around = regions(text) if text else []
                more = [x for a, b in around for x in added_spans(field, a, text[a:b], text[max(0, a - 16):a], text[b:b + 8], own)]
                new.append(masked(text, [*own, *more]) if own or more else text)
            columns, names = list(batch.columns), batch.schema.names
            columns[names.index("text")] = pa.array(new, batch.column("text").type)
            if count:
                lengths = [n if a == b else len(b) for a, b, n in zip(old, new, batch.column(count).to_pylist())]
                columns[names.index(count)] = pa.array(lengths, batch.column(count).type)
            yield pa.RecordBatch.from_arrays(columns, names=names)

    return documents.mapInArrow(run, documents.schema)


def mask_personal_data(documents: DataFrame) -> DataFrame:
    """Fit the field on the documents, then mask them."""
    return mask(documents, field_of(written(scan(documents), "regions")))


def op10_pii(spark: SparkSession, folder: str) -> DataFrame:
    """Personal data of every document: pattern counts and digest, and all spans."""
    found = personal_data(table(spark, folder, "documents"))
    names = F.array(*[F.lit(k) for k in KINDS])

    def listed(spans: str):
        return F.array_join(F.transform(spans, lambda s: F.concat_ws(":", F.get(names, s["kind"]), s["start"].cast("string"), s["end"].cast("string"))), ",")

    def count(k: int):
        return F.size(F.filter("base", lambda s: s["kind"] == k)).cast("long").alias(f"n_{KINDS[k]}")

    counts = [count(k) for k in range(len(KINDS))]
    return found.select("doc_id", *counts, F.sha2(listed("base").cast("binary"), 256).alias("base_sha256"), listed("spans").alias("spans"))
