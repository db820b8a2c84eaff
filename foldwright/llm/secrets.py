"""Secret scans (operator 5): base patterns and multipart credential linking.

Parts of credentials are found with their places: identifiers, secrets and
endpoints. Strong parts (the base patterns) always count. Weak ones are common
in clean text and count only together with complementary parts in the same
scope, however far apart: a paragraph, or neighbouring paragraphs whose adjoining
lines are both key and value, as in a configuration. Scopes lie inside one text,
so the interval join runs where the text is read and moves nothing. A null text
counts as empty.
"""

from __future__ import annotations

import hashlib
import re
from bisect import bisect_left
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

KINDS = ["assign", "access", "hex"]
ASSIGN = re.compile(r"""(?a)((?i:password|passwd|secret|token|api_?key))["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""")
# runs are maximal, so a least length in the pattern finds what dropping short runs would leave
ACCESS = re.compile(r"AKIA[A-Z0-9]{14,}")
HEX = re.compile(r"[0-9a-f]{16,}")
WEAK_NAMES = re.compile(r"""(?a)\b(?i:user(?:_?name)?|login|account|client_?id|access_?key(?:_?id)?)["']?\x20*[:=]\x20*["']?([A-Za-z0-9@+_.-]{3,})""")
WEAK_SECRETS = re.compile(r"""(?a)\b(?i:pass(?:word|wd|phrase)?|pwd|secret|token|api_?key|private_?key|credentials?)["']?\x20*[:=]\x20*["']?([^\s"',;]{6,})""")
ENDPOINTS = re.compile(r"""(?a)\b(?:(?:https?|ftp|ssh|jdbc:[a-z]+|postgres(?:ql)?|mysql|mongodb|redis|amqp)://[^\s"'<>]+|(?i:host(?:name)?|server|endpoint)["']?\x20*[:=]\x20*["']?[A-Za-z0-9.-]+(?::\d+)?)""")
SCOPE = re.compile(r"\n[ \t\r]*\n")
KEY_LINE = re.compile(r"""[ \t]*[\w.\-\[\]"']+[ \t]*[:=][ \t]*\S.*""")
#: parts that a weak part of a kind needs in its scope: any of one group, for each group
NEEDS = {"weak_id": ({"secret"},), "weak_secret": ({"id", "endpoint"},), "endpoint": ({"id"}, {"secret"})}
ROLE = {"assign": "secret", "hex": "secret", "access": "id", "weak_id": "id", "weak_secret": "secret", "endpoint": "endpoint"}

Span = tuple[int, int, str]


def base_spans(text: str) -> list[Span]:
    found = [(m.start(), m.end(), "assign") for m in ASSIGN.finditer(text) if len(m[2]) >= 12]
    found += [(m.start(), m.end(), "access") for m in ACCESS.finditer(text)]
    found += [(m.start(), m.end(), "hex") for m in HEX.finditer(text)]
    return sorted(found, key=_order)


def _order(span: Span) -> tuple[int, int, str, int]:
    return span[0], KINDS.index(span[2]) if span[2] in KINDS else len(KINDS), span[2], span[1]


def scope_breaks(text: str) -> list[int]:
    """Where scopes end: blank lines but those between two lines of key and value."""
    out = []
    for m in SCOPE.finditer(text):
        before = text[text.rfind("\n", 0, m.start()) + 1 : m.start()]
        end = text.find("\n", m.end())
        if not (KEY_LINE.fullmatch(before.rstrip("\r")) and KEY_LINE.fullmatch(text[m.end() : end if end >= 0 else len(text)].rstrip("\r"))):
            out.append(m.start())
    return out


def linked_spans(text: str, base: list[Span]) -> list[Span]:
    """Weak parts that have what they need in their scope; parts inside base spans are theirs."""
    weak = [(m.start(), m.end(), "weak_id") for m in WEAK_NAMES.finditer(text)]
    weak += [(m.start(), m.end(), "weak_secret") for m in WEAK_SECRETS.finditer(text)]
    if not weak and not any(k == "access" for _, _, k in base):
        return []
    weak += [(m.start(), m.end(), "endpoint") for m in ENDPOINTS.finditer(text)]
    weak = sorted(s for s in weak if not any(a <= s[0] < b or s[0] <= a < s[1] for a, b, k in _near(base, s) if k != "hex"))
    if not weak:
        return []
    breaks = scope_breaks(text)
    scope = lambda span: bisect_left(breaks, span[0] + 1)
    # spans join scopes by the interval they start in
    roles: dict[int, set[str]] = {}
    for span in base + weak:
        roles.setdefault(scope(span), set()).add(ROLE[span[2]])
    return [s for s in weak if all(roles[scope(s)] & group for group in NEEDS[s[2]])]


def _near(base: list[Span], span: Span) -> list[Span]:
    """Base spans that may overlap ``span``: the two before its end's place and those that start inside."""
    i = bisect_left(base, (span[0], 0, ""))
    j = bisect_left(base, (span[1], 0, ""))
    return base[max(0, i - 3) : j]


def joined(spans: list[Span]) -> str:
    return ",".join(f"{k}:{a}:{b}" for a, b, k in spans)


def find_secrets(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """``(id, n_assign, n_access, n_hex, base_sha256, spans, n_linked)`` for each row of ``docs``."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            rows = []
            for value in batch.column(1):
                text = value.as_py() or ""
                base = base_spans(text)
                linked = linked_spans(text, base)
                every = joined(sorted(base + linked, key=_order))
                rows.append((*(sum(k == kind for _, _, k in base) for kind in KINDS), hashlib.sha256(joined(base).encode()).hexdigest(), every, len(linked)))
            kinds = (pa.int64(), pa.int64(), pa.int64(), pa.string(), pa.string(), pa.int64())
            yield pa.RecordBatch.from_arrays([batch.column(0), *(pa.array([r[i] for r in rows], t) for i, t in enumerate(kinds))], names=["id", "n_assign", "n_access", "n_hex", "base_sha256", "spans", "n_linked"])

    kind = docs.schema[id_col].dataType.simpleString()
    rows = docs.select(F.col(id_col).alias("id"), F.col(text_col).cast("string").alias("text"))
    return rows.mapInArrow(run, f"id {kind}, n_assign long, n_access long, n_hex long, base_sha256 string, spans string, n_linked long")


def mask(text: str, mark: str = "[SECRET]") -> str:
    """``text`` with every found part but endpoints replaced."""
    base = base_spans(text)
    out, last = [], 0
    for a, b, kind in sorted(base + linked_spans(text, base)):
        if kind != "endpoint" and b > last:
            if a >= last:
                out += [text[last:a], mark]
            last = b
    return "".join([*out, text[last:]]) if out else text


def mask_secrets(docs: DataFrame, text_col: str = "text", length_col: str = "n_chars") -> DataFrame:
    """``docs`` with secrets masked and ``length_col``, if there is one, counted again where a text changed."""
    place = docs.columns.index(text_col)
    count = docs.columns.index(length_col) if length_col in docs.columns else -1

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            old = batch.column(place).to_pylist()
            new = [x if x is None else mask(x) for x in old]
            columns = list(batch.columns)
            columns[place] = pa.array(new, batch.schema.field(place).type)
            if count >= 0:
                sizes = [n if a is b or a == b else len(b) for n, a, b in zip(columns[count].to_pylist(), old, new, strict=True)]
                columns[count] = pa.array(sizes, batch.schema.field(count).type)
            yield pa.RecordBatch.from_arrays(columns, schema=batch.schema)

    return docs.mapInArrow(run, docs.schema)
