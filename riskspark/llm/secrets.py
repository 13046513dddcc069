"""Operator 4: secret scans, in DataFrame functions only.

Base kinds are found by pattern. The method adds spans by entropy: candidate strings (long runs of one
character class) are read once with a sliding window of ``WINDOW`` characters; the counts of the window's
characters and the sum of c*log2(c) change by one entering and one leaving character a step, so the
Shannon entropy of each window is at hand without recounting. Windows at or above the class's threshold
are spans (overlapping ones merge). The allow list's anchored patterns judge a whole candidate, which is passed over;
what the others match is cut out of the candidate, and windows that overlap it are passed over, the rest is read.

Null and empty texts give no spans. Offsets are code points, end exclusive. Rows are handled one by one,
so repeated rows give repeated results; other columns are kept, except those named like the results.
"""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from riskspark.llm.common import table

# The base kinds. (pattern, group that is measured, least length of that group)
BASE = {
    "assign": (r"""((?i:password|passwd|secret|token|api_?key))["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""", 2, 8),
    "access": (r"AKIA[A-Z0-9]+", 0, 16),
    "hex": (r"[0-9a-f]+", 0, 32),
}
# A run below the least length can't hold a longer one, so the scan may ask for the length at once.
SCAN = {"assign": BASE["assign"][0], "access": r"AKIA[A-Z0-9]{12,}", "hex": r"[0-9a-f]{32,}"}

WINDOW = 20
STRETCH = 512  # windows that are read with one set of counts
RUN = 256  # elements of an array whose running sums are taken together
# Character classes of the entropy scan: (alphabet, candidate pattern, pattern that a candidate must hold, bits)
CLASSES = {
    "entropy_hex": ("0123456789abcdef", r"(?<![A-Za-z0-9])[0-9a-f]{20,}(?![A-Za-z0-9])", r"^(?=.*[0-9])(?=.*[a-f])", 3.0),
    "entropy_text": ("ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789+/_-", r"[A-Za-z0-9+/_-]{20,}", r"^(?=.*[0-9])(?=.*[A-Z])(?=.*[a-z])", 3.8),
    "entropy_upper_hex": ("0123456789ABCDEF", r"(?<![A-Za-z0-9])[0-9A-F]{20,}(?![A-Za-z0-9])", r"^(?=.*[0-9])(?=.*[A-F])", 3.0),
    # of random strings of 20 characters in base32 or base36, 99 % reach 3.3 bits; runs of hex digits alone are left to their classes
    "entropy_upper": ("ABCDEFGHIJKLMNOPQRSTUVWXYZ0123456789", r"(?<![A-Za-z0-9])[A-Z0-9]{20,}(?![A-Za-z0-9])", r"^(?=.*[0-9])(?=.*[G-Z])", 3.3),
    "entropy_lower": ("abcdefghijklmnopqrstuvwxyz0123456789", r"(?<![A-Za-z0-9])[a-z0-9]{20,}(?![A-Za-z0-9])", r"^(?=.*[0-9])(?=.*[g-z])", 3.3),
}
# Strings that look random but are no secrets: placeholders, one or two characters repeated, UUIDs, dates in names,
# a word and a number. A group that repeats without bound must be possessive: Java's matcher goes one call deeper for
# each round of any other, and a long candidate would end the JVM.
ALLOW = (r"(?i)example|sample|placeholder|changeme|dummy|xxxx", r"^(.{1,2})\1+.?$",
         r"(?i)^[0-9a-f]{8}(-[0-9a-f]{4}){3}-[0-9a-f]{12}$", r"(?i)^[a-z]++(?:[-_/][a-z]++)*+[-_/]?(19|20)[0-9]{2}[-_/]?[0-9]{0,2}[-_/]?[0-9]{0,2}$",
         r"(?i)^[a-z]+[0-9]{1,4}$")
KINDS = (*BASE, *CLASSES)
SPAN = "array<struct<start:int,kind:int,end:int>>"


def _quote(s: str) -> str:
    return "'" + s.replace("\\", "\\\\").replace("'", "\\'") + "'"


def _let(name: str, value: str, body: str) -> str:
    """SQL: ``body`` with ``name`` standing for ``value``, which is worked out once."""
    return f"transform(array({value}), {name} -> {body})[0]"


def _starts(sizes: str, first: str = "0") -> str:
    """SQL: running sums of an array before each element, in blocks, so that no long array is appended to."""
    inner = f"""transform(sequence(0, cast((size(z) - 1) div {RUN} as int)), b -> aggregate(slice(z, b * {RUN} + 1, {RUN}),
        named_struct('pos', 0, 'out', cast(array() as array<int>)), (a, x) -> named_struct('pos', a.pos + x, 'out', array_append(a.out, a.pos))))"""
    before = f"""aggregate(runs, named_struct('pos', {first}, 'out', cast(array() as array<int>)),
        (a, r) -> named_struct('pos', a.pos + r.pos, 'out', array_append(a.out, a.pos)), a -> a.out)"""
    return _let("z", sizes, _let("runs", inner, _let("before", before, "flatten(zip_with(runs, before, (r, p) -> transform(r.out, q -> q + p)))")))


def _matches(text: str, pattern: str, group: int) -> str:
    """SQL: array of (start, len, value) of all matches: the pieces between matches give the places."""
    p = _quote(pattern)
    found = f"""filter(zip_with(zip_with(split({text}, {p}, -1), regexp_extract_all({text}, {p}, 0), (gap, found) -> named_struct('gap', length(gap), 'len', length(found))),
        regexp_extract_all({text}, {p}, {group}), (x, part) -> named_struct('gap', x.gap, 'len', x.len, 'part', part)), x -> x.len is not null)"""
    return _let("found", found, f"""zip_with(found, {_starts("transform(found, x -> x.gap + x.len)")},
        (x, s) -> named_struct('start', s + x.gap, 'len', x.len, 'value', x.part))""")


def _between(found: str, pattern: str) -> str:
    """SQL: (start, len, value) of what lies between the matches of ``pattern`` in each of ``found``, its places in the text."""
    p = _quote(pattern)
    pieces = f"""zip_with(split(m.value, {p}, -1), regexp_extract_all(m.value, {p}, 0), (gap, cut) -> named_struct('gap', gap, 'len', length(gap) + coalesce(length(cut), 0)))"""
    cut = _let("pieces", pieces, f"""zip_with(pieces, {_starts("transform(pieces, x -> x.len)", "m.start")},
        (x, s) -> named_struct('start', s, 'len', length(x.gap), 'value', x.gap))""")
    return f"flatten(transform({found}, m -> if(not m.value rlike {p}, array(m), {cut})))"


def _merged(spans: str) -> str:
    """SQL: spans in order, neighbours that touch or overlap made one: each begins where the one before ends earlier."""
    heads = "filter(transform(own, (x, i) -> if(i = 0 or x.start > get(own, i - 1).end, i, -1)), i -> i >= 0)"
    return _let("own", spans, _let("heads", heads, """transform(heads, (h, j) -> named_struct('start', get(own, h).start, 'kind', get(own, h).kind,
        'end', get(own, coalesce(get(heads, j + 1), size(own)) - 1).end))"""))


def _base_spans(text: str, kind: str) -> str:
    least, group = BASE[kind][2], BASE[kind][1]
    return f"""if({text} rlike {_quote(SCAN[kind])},
        cast(transform(filter({_matches(text, SCAN[kind], group)}, m -> length(m.value) >= {least}),
            m -> named_struct('start', m.start, 'kind', {KINDS.index(kind)}, 'end', m.start + m.len)) as {SPAN}),
        cast(array() as {SPAN}))"""


def _entropy_spans(text: str, kind: str, window: int, allow: tuple[str, ...], bits: float | None) -> str:
    alphabet, pattern, holds, usual = CLASSES[kind]
    bits = usual if bits is None else bits
    f = "array(" + ",".join(repr(c * math.log2(c)) + "D" if c else "0.0D" for c in range(window + 1)) + ")"
    most = repr((math.log2(window) - bits) * window + 1e-9) + "D"  # H = log2(window) - sum(c log2 c) / window
    allowed = " or ".join(f"c.value rlike {_quote(a)}" for a in allow if "^" in a) or "false"
    found = f"filter({_matches(text, pattern, 0)}, c -> not ({allowed}))"
    cut = "|".join(f"(?:{a})" for a in allow if "^" not in a)
    found = _between(found, cut) if cut else found
    # a stretch is STRETCH windows of a candidate: a step's cost depends on it, not on the candidate's length
    stretch = f"""aggregate(
        slice(zip_with(z, concat(array_repeat(-1, {window}), z), (code, old) -> named_struct('code', code, 'old', old)), 1, size(z)),
        named_struct('i', 0, 'counts', array_repeat(0, {len(alphabet)}), 'sum', 0.0D, 'out', cast(array() as {SPAN})),
        (a, x) -> {{step}},
        a -> a.out)"""
    # one step: `old` leaves (or -1), `code` enters; n_old and n_in are their counts before
    step = f"""transform(array(named_struct('n_old', if(x.old < 0, 0, element_at(a.counts, x.old + 1)),
                                     'n_in', element_at(a.counts, x.code + 1) - if(x.old = x.code, 1, 0))), n ->
        transform(array(a.sum + if(x.old < 0, 0.0D, element_at({f}, n.n_old) - element_at({f}, n.n_old + 1))
                        + element_at({f}, n.n_in + 2) - element_at({f}, n.n_in + 1)), s ->
        named_struct('i', a.i + 1,
            'counts', transform(a.counts, (v, k) -> v + if(k = x.code, 1, 0) - if(k = x.old, 1, 0)),
            'sum', s,
            'out', if(a.i + 1 < {window} or s > {most}, a.out,
                if(size(a.out) > 0 and element_at(a.out, -1).end >= at + a.i + 1 - {window},
                   array_append(slice(a.out, 1, size(a.out) - 1),
                        named_struct('start', element_at(a.out, -1).start, 'kind', {KINDS.index(kind)}, 'end', at + a.i + 1)),
                   array_append(a.out, named_struct('start', at + a.i + 1 - {window}, 'kind', {KINDS.index(kind)}, 'end', at + a.i + 1))))
        ))[0])[0]"""
    windows = _let("codes", f"transform(split(c.value, ''), ch -> instr({_quote(alphabet)}, ch) - 1)", _merged(f"""cast(flatten(transform(
        sequence(0, cast((c.len - {window}) div {STRETCH} as int)), b -> {_let("at", f"c.start + b * {STRETCH}",
            _let("z", f"slice(codes, b * {STRETCH} + 1, {STRETCH + window - 1})", stretch.format(step=step)))})) as {SPAN})"""))
    return f"""if({text} rlike {_quote(pattern)},
        cast(flatten(transform(filter({found}, c -> c.len >= {window} and c.value rlike {_quote(holds)}),
            c -> {windows})) as {SPAN}),
        cast(array() as {SPAN}))"""


def scan(df: DataFrame, text: str = "text", window: int = WINDOW, allow: tuple[str, ...] = ALLOW, bits: dict[str, float] | None = None) -> DataFrame:
    """``df`` with ``secret_spans``: array of (start, kind as number in KINDS, end), by start, then kind.
    ``window`` is the entropy window, ``allow`` the patterns of harmless candidates (with '^') or parts, ``bits`` thresholds by class."""
    t = f"coalesce(`{text}`, '')"
    found = [_base_spans(t, k) for k in BASE] + [_entropy_spans(t, k, window, allow, (bits or {}).get(k)) for k in CLASSES]
    return df.withColumn("secret_spans", F.expr(f"array_sort(concat({', '.join(found)}))"))


def written(spans: str) -> Column:
    """kind:start:end of each span, joined by commas."""
    kinds = "array(" + ",".join(map(_quote, KINDS)) + ")"
    return F.expr(f"array_join(transform({spans}, s -> concat(element_at({kinds}, s.kind + 1), ':', s.start, ':', s.end)), ',')")


def redact(df: DataFrame, text: str = "text", mark: str = "[SECRET]") -> DataFrame:
    """``df`` (as scan() returns it) with each span of ``text`` replaced by ``mark``; spans that touch or overlap
    are one. Texts without spans, null among them, stay as they are."""
    whole = """aggregate(secret_spans, cast(array() as array<struct<start:int,end:int>>), (a, s) -> if(size(a) > 0 and s.start <= element_at(a, -1).end,
        array_append(slice(a, 1, size(a) - 1), named_struct('start', element_at(a, -1).start, 'end', greatest(element_at(a, -1).end, s.end))),
        array_append(a, named_struct('start', s.start, 'end', s.end))))"""
    parts = f"""concat(array_join(transform(cuts, (c, i) -> substring(`{text}`, coalesce(get(cuts, i - 1).end, 0) + 1, c.start - coalesce(get(cuts, i - 1).end, 0))), {_quote(mark)}),
        {_quote(mark)}, substring(`{text}`, element_at(cuts, -1).end + 1, length(`{text}`)))"""
    return df.withColumn(text, F.expr(f"if(size(secret_spans) = 0, `{text}`, {_let('cuts', whole, parts)})"))


def without_secrets(df: DataFrame) -> DataFrame:
    """``df`` with the secrets of ``text`` redacted; ``n_chars``, where it is there, counts the new text."""
    columns = df.columns
    out = redact(scan(df))
    if "n_chars" in columns:
        out = out.withColumn("n_chars", F.when(F.size("secret_spans") > 0, F.length("text")).otherwise(F.col("n_chars")).cast(df.schema["n_chars"].dataType))
    return out.select(*[F.col(f"`{c}`") if c != "secret_spans" else F.lit(None).cast(df.schema[c].dataType).alias(c) for c in columns])


def op4_secret_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Per document: doc_id, n_assign, n_access, n_hex, base_sha256, spans."""
    found = scan(table(spark, sf_dir, "documents").select("doc_id", "text")).drop("text")
    count = {f"n_{k}": F.expr(f"cast(size(filter(secret_spans, s -> s.kind = {i})) as long)") for i, k in enumerate(BASE)}
    return found.withColumns(count).select(
        "doc_id", *count,
        F.sha2(written(f"filter(secret_spans, s -> s.kind < {len(BASE)})"), 256).alias("base_sha256"),
        written("secret_spans").alias("spans"))


QUERIES = {"op4_secret_scan": op4_secret_scan}
