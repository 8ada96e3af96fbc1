"""Secret scans with multipart credential linking.

Every text is searched once, in an Arrow function, for the base kinds (assignments, access keys,
long hex runs) and for *weak parts* that mean little alone: an access identifier (user or client
names under a key that ends in one, short access keys, e-mail addresses, the name in a URL), a weak secret (an
assigned value that is too short, a shorter hex run, a base64-like word with both cases and digits, the
password in a URL), and an endpoint (a URL or host with a port). A weak
identifier or secret is reported only when a complementary part stands within ``SCOPE`` code
points: an identifier needs a secret nearby, a secret an identifier or an endpoint; the endpoint is
reported with the credential it belongs to. Base spans count as complementary parts but always stay.

Parts are intervals, and the distance of two is the gap between them: the start of the later minus the
end of the earlier, 0 where they overlap. Identifiers and secrets inside an endpoint link like any
other part, with the endpoint too; there ``/`` ends a word unless it follows ``=``, else each path
would be one. Linked weak parts that overlap are reported as one span, under the first one's kind.

The interval join is a sweep over the parts of one text in order of position: each weak part asks
whether the nearest complementary part on either side ends or starts within its scope, so it costs
n log n of a text's own parts and lists no pairs. A scope never crosses a document, hence the whole
operator is one pass without a shuffle, and a lost executor costs its own partitions only.

Spans are in code points, end exclusive. Defined results: a null text is empty (no spans); each
row stands for itself, so a repeated id gives repeated rows with their own spans; an empty table
gives an empty result; other columns, whatever their names, are kept by ``redact`` and not read.
"""

from __future__ import annotations

import hashlib
import re
from bisect import bisect_left, bisect_right
from itertools import accumulate

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from factweave.llm.common import byte_chunks, map_text

KINDS = ["assign", "access", "hex", "identifier", "weak_secret", "endpoint"]  # spans at one start are listed in this order
BASE = KINDS[:3]
ROLE = {"assign": "secret", "access": "id", "hex": "secret", "identifier": "id", "weak_secret": "secret", "endpoint": "end"}
SCOPE = 200

_ASSIGN = re.compile(r"""(password|passwd|secret|token|api_?key)["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""", re.ASCII | re.IGNORECASE)
_ACCESS = re.compile(r"AKIA[A-Z0-9]+")
_HEX = re.compile(r"(?<![0-9a-f])[0-9a-f]{16,}")
_IDENTIFIER = re.compile(r"""(?<![A-Za-z0-9_])(?:[A-Za-z0-9]+_)*(?:user(?:name|_?id)?|login|account(?:_?id)?|client_?id|access_?key_?id)["']?\x20*[:=]\x20*["']?[A-Za-z0-9+/_.@-]{3,}""", re.ASCII | re.IGNORECASE)
_WORD = re.compile(r"(?<![A-Za-z0-9+/_-])[A-Za-z0-9+/_-]{20,}={0,2}")
_URL_WORD = re.compile(r"(?:(?<==)[A-Za-z0-9+/_-]{20,}|(?<![A-Za-z0-9+_-])[A-Za-z0-9+_-]{20,})={0,2}")  # letters and digits are tested apart
_EMAIL = re.compile(r"(?<![A-Za-z0-9._%+-])[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(?:\.[A-Za-z0-9-]+)+")
_USERINFO = re.compile(r"://([^\s/:@\"'<>]+):([^\s/:@\"'<>]+)@")
_MIXED = re.compile(r"(?=[^0-9]*[0-9])(?=[^a-z]*[a-z])[^A-Z]*[A-Z]")
_ENDPOINT = re.compile(r"(?<![A-Za-z0-9])(?:(?:https?|ftp|ssh|s3|jdbc:[a-z]+|postgres(?:ql)?|mysql|mongodb|redis|amqp)://[A-Za-z0-9][^\s\"'<>]*|[A-Za-z0-9](?:[A-Za-z0-9-]*\.)+[A-Za-z]{2,}:[0-9]{2,5}(?![0-9]))")

# cheap byte tests: a text that passes none of a test's words cannot hold a match of its patterns
_MARKS = {"assign": (b"password", b"passwd", b"secret", b"token", b"apikey", b"api_key"),
          "identifier": (b"user", b"login", b"account", b"client", b"access"),
          "endpoint": (b"://",)}
_PORT = re.compile(rb"[A-Za-z]:[0-9]{2}")
_DIGIT_WORD = re.compile(rb"[A-Za-z0-9+/_-]{20}")
_HEX_RUN = re.compile(rb"[0-9a-f]{16}")


def find_parts(raw: bytes) -> list[tuple[str, int, int]]:
    """Base spans and weak parts of one text, sorted by start and kind.

    Of identifiers and weak secrets that overlap, the first stays, and those touching a base span are left out; an
    endpoint is left out only inside a base span, and hides no other part.
    """
    low = raw.lower()
    wanted = {k for k, marks in _MARKS.items() if any(m in low for m in marks)}
    has_hex, has_word, has_access = _HEX_RUN.search(raw), _DIGIT_WORD.search(raw), b"AKIA" in raw
    if not wanted and not has_hex and not has_word and not has_access and b"@" not in raw and not _PORT.search(raw):
        return []
    text = raw.decode("utf-8", "replace")
    base, weak = [], []
    if "assign" in wanted:
        for m in _ASSIGN.finditer(text):
            if len(m[2]) >= 6:
                base.append(("assign", *m.span()))
            else:
                weak.append(("weak_secret", *m.span()))
    if has_access:
        for m in _ACCESS.finditer(text):
            if len(m[0]) >= 20:
                base.append(("access", *m.span()))
            else:
                weak.append(("identifier", *m.span()))
    if has_hex:
        for m in _HEX.finditer(text):
            if len(m[0]) >= 24:
                base.append(("hex", *m.span()))
            else:
                weak.append(("weak_secret", *m.span()))
    if "identifier" in wanted:
        weak += [("identifier", *m.span()) for m in _IDENTIFIER.finditer(text)]
    if b"@" in raw:
        userinfo = list(_USERINFO.finditer(text)) if "endpoint" in wanted else []
        inside = {m.start(g) for m in userinfo for g in (1, 2)}  # a password before a host is no mailbox, nor name and password one value
        weak = [p for p in weak if p[1] not in inside] + [p for m in userinfo for p in (("identifier", *m.span(1)), ("weak_secret", *m.span(2)))]
        weak += [("identifier", *m.span()) for m in _EMAIL.finditer(text) if m.start() not in inside]
    endpoints = [("endpoint", *m.span()) for m in _ENDPOINT.finditer(text)] if "endpoint" in wanted or _PORT.search(raw) else []
    if has_word:
        begins = [s for _, s, _ in endpoints]
        for m in _WORD.finditer(text):
            i = bisect_right(begins, m.start())
            if (not i or endpoints[i - 1][2] <= m.start()) and _MIXED.match(m[0]):
                weak.append(("weak_secret", *m.span()))
        for _, s, e in endpoints:
            weak += [("weak_secret", *m.span()) for m in _URL_WORD.finditer(text, s, e) if _MIXED.match(m[0])]
    base.sort(key=lambda s: s[1])
    out = base
    if weak:
        kept, covered = [], base
        weak.sort(key=lambda s: (s[1], -s[2]))
        i = end = 0
        for s in weak:  # both lists run by start; a weak part touching a base span or an earlier weak part is dropped
            while i < len(covered) and covered[i][2] <= s[1]:
                i += 1
            if s[1] >= end and not any(c[1] < s[2] for c in covered[i:i + 3]):
                kept.append(s)
                end = s[2]
        out = out + kept
    if endpoints:
        starts, ends = [s[1] for s in base], list(accumulate((s[2] for s in base), max))
        out += [p for p in endpoints if not (i := bisect_right(starts, p[1])) or ends[i - 1] < p[2]]
    return sorted(out, key=lambda s: (s[1], KINDS.index(s[0])))


def joined(spans) -> str:
    return ",".join(f"{k}:{s}:{e}" for k, s, e in spans)


def link(parts: list[tuple[str, int, int]], scope: int = SCOPE) -> list[tuple[str, int, int]]:
    """Base spans plus the weak parts that a complementary part within ``scope`` code points confirms."""
    at = {r: [(s, e) for k, s, e in parts if ROLE[k] == r] for r in ("id", "secret", "end")}  # by start, as parts are
    starts = {r: [s for s, _ in spans] for r, spans in at.items()}
    ends = {r: list(accumulate((e for _, e in spans), max)) for r, spans in at.items()}  # the last end so far: spans may nest

    def near(role, start, end):
        i = bisect_left(starts[role], start)
        return i > 0 and start - ends[role][i - 1] <= scope or i < len(starts[role]) and starts[role][i] - end <= scope

    complement = {"id": ("secret",), "secret": ("id", "end"), "end": ("secret",)}
    return [p for p in parts if p[0] in BASE or any(near(r, p[1], p[2]) for r in complement[ROLE[p[0]]])]


def reported(parts: list[tuple[str, int, int]]) -> list[tuple[str, int, int]]:
    """Linked parts as spans: base spans as they are, overlapping weak parts as one span of the first one's kind."""
    out, last = [p for p in parts if p[0] in BASE], None
    for k, s, e in sorted((p for p in parts if p[0] not in BASE), key=lambda p: (p[1], -p[2])):
        if last and s < last[2]:
            last = (last[0], last[1], max(last[2], e))
            out[-1] = last
        else:
            last = (k, s, e)
            out.append(last)
    return sorted(out, key=lambda p: (p[1], KINDS.index(p[0])))


def secret_scan(docs: DataFrame) -> DataFrame:
    """(doc_id, n_assign, n_access, n_hex, base_sha256, spans, n_linked) of every document."""
    def run(batches):
        for rows, texts in byte_chunks(batches, "text"):
            found = [reported(link(find_parts(t))) for t in texts]
            base = [[s for s in f if s[0] in BASE] for f in found]
            yield ([rows.column(0)] + [[sum(s[0] == k for s in b) for b in base] for k in BASE]
                   + [[hashlib.sha256(joined(b).encode()).hexdigest() for b in base], [joined(f) for f in found],
                      [len(f) - len(b) for f, b in zip(found, base)]])

    return map_text(docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text")), run,
                    "doc_id long, n_assign long, n_access long, n_hex long, base_sha256 string, spans string, n_linked long")


def replaced(text: str, spans: list[tuple[str, int, int]], mark: str) -> str:
    """``text`` with the union of the spans replaced by ``mark``, one mark for spans that touch or overlap."""
    out, at, end = [], 0, -1
    for _, s, e in sorted(spans, key=lambda p: p[1:]):
        if s > end:
            out += [text[at:s] if end < 0 else text[end:s], mark]
        at, end = e, max(end, e)
    return "".join(out) + text[max(end, 0):]


def redact(docs: DataFrame, mark: str = "[SECRET]") -> DataFrame:
    """``docs`` with every span (base and linked) of its texts replaced by ``mark``; ``n_chars`` follows the new text.

    Texts without spans, null texts and all other columns stay as they are.
    """
    columns = docs.columns
    text, chars = columns.index("text"), columns.index("n_chars") if "n_chars" in columns else None
    schema = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in docs.schema.fields)

    def run(batches):
        for rows, texts in byte_chunks(batches, "text"):
            values = [rows.column(i) for i in range(len(columns))]
            changed = {i: replaced(t.decode("utf-8", "replace"), spans, mark)
                       for i, t in enumerate(texts) if (spans := link(find_parts(t)))}
            if changed:
                new = values[text].to_pylist()
                for i, t in changed.items():
                    new[i] = t
                if chars is not None:
                    n = values[chars].to_pylist()
                    for i, t in changed.items():
                        n[i] = len(t)
                    values[chars] = pa.array(n, values[chars].type)
                values[text] = pa.array(new, values[text].type)
            yield values

    return map_text(docs, run, schema)
