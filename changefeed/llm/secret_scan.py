"""Secret scan: patterns, and sliding-window Shannon entropy over candidate strings.

A window of 20 characters slides over every candidate of a character class. Its entropy is
log2(20) - sum(c * log2 c) / 20 over the counts c of its characters; the sum changes by one
character out and one in at each step, so a step costs the same for any window. All of it
is built-in column functions.
"""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

WINDOW = 20

# The base patterns by kind, the condition a match must meet, and a quick test that a text may have any.
BASE = ("assign", "access", "hex")
ASSIGN = r"""(?i)(password|passwd|secret|token|api_?key)["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)"""
ASSIGN_HINT = r"""(?i)(?:word|passwd|secret|token|key)["']?\x20*[:=]"""
ACCESS = "AKIA[A-Z0-9]{14,}"  # the same spans as any length and then 18 characters or more
HEX = "[0-9a-f]{16,}"  # likewise
LEAST_ASSIGNED = 12

# Character classes of candidates, with the least entropy, in bits, that some window must reach.
CLASSES = {
    "entropy_hex": ("[0-9A-Fa-f]", 2.95),
    "entropy_upper": ("[0-9A-Z]", 3.45),
    "entropy_base64": ("[0-9A-Za-z+/_=-]", 3.85),
}
CANDIDATE_HINT = "[0-9A-Za-z+/_=-]{%d}" % WINDOW

# What is no secret as a whole: words, numbers, identifiers made of words, unique ids.
ALLOW = (
    "^[A-Za-z]+$",
    "^[0-9]+$",
    "^[A-Za-z]+(?:[-_/][A-Za-z]+)+$",
    "(?i)^[0-9a-f]{8}-[0-9a-f]{4}-[0-9a-f]{4}-[0-9a-f]{4}-[0-9a-f]{12}$",
)
# Signs between the parts of a candidate, and what makes a part a placeholder: runs of an alphabet and filler words.
SIGNS = "-_=+/"
PLACEHOLDER = (
    "abcdefgh|01234567|12345678|qwertyui|example|sample|dummy|placeholder|changeme|x{6}|"
    "your[-_]?(?:key|token|secret)|test[-_]?(?:key|token|secret)"
)
# A placeholder's whole part, from its first letter on, or a row of signs: what stands around it is judged by itself.
CUT = f"(?i)[{SIGNS}]{{4,}}|(?:^|(?<=[{SIGNS}]))[^{SIGNS}]*?(?:{PLACEHOLDER})[^{SIGNS}]*"
STRIP = f"^[{SIGNS}]+|[{SIGNS}]+$"
KINDS = (*BASE, *CLASSES)
SPAN = "array<struct<start:bigint,rank:int,end:bigint,text:string>>"


def quoted(pattern: str) -> str:
    return "r'" + pattern.replace("'", "\\x27") + "'"


def spans(pattern: str, kind: str, group: int = 0) -> str:
    """SQL: the matches of a pattern in `body` as (start, rank, end, text of the group).

    Matches and the text between them alternate, so running sums of their lengths are places in
    code points.
    """
    matches = f"regexp_extract_all(body, {quoted(pattern)}, 0)"
    named = matches if group == 0 else f"regexp_extract_all(body, {quoted(pattern)}, {group})"
    parts = f"arrays_zip(split(body, {quoted(pattern)}, -1), {matches}, {named})"
    parts = f"cast({parts} as array<struct<gap:string,hit:string,named:string>>)"
    step = (
        "(acc, x) -> named_struct('at', acc.at + length(x.gap) + length(x.hit), 'out', concat(acc.out, array(named_struct("
        f"'start', acc.at + length(x.gap), 'rank', {KINDS.index(kind)}, 'end', acc.at + length(x.gap) + length(x.hit), "
        "'text', x.named))))"
    )
    zero = f"named_struct('at', 0L, 'out', cast(array() as {SPAN}))"
    return f"aggregate(filter({parts}, x -> x.hit is not null), {zero}, {step}, acc -> acc.out)"


def least_sum(bits: float) -> float:
    """The largest sum of c * log2 c over a window that still has so many bits."""
    return WINDOW * (math.log2(WINDOW) - bits)


def lowest_sum(text: str) -> str:
    """SQL: the smallest sum of c * log2 c over all windows of a string, by counts that change with each step."""
    first, size = 43, 80  # the classes lie between "+" and "z"
    bits, held = 5, 12  # a count of up to 20 takes five bits; twelve counts share a number, so a step rewrites seven numbers
    terms = "array(" + ", ".join(f"{c * math.log2(c) if c else 0.0!r}D" for c in range(WINDOW + 1)) + ")"
    codes = f"transform(split({text}, ''), c -> ascii(c) - {first})"

    def event(code: str, by: int) -> str:
        return f"struct({code} div {held} as word, cast({bits} * ({code} % {held}) as int) as at, {by}L as by)"

    events = (
        f"transform(array({codes}), codes -> flatten(transform(sequence(0, size(codes) - 1), i -> "
        f"if(i >= {WINDOW}, array({event(f'codes[i - {WINDOW}]', -1)}, {event('codes[i]', 1)}), "
        f"array({event('codes[i]', 1)})))))[0]"
    )
    count = f"cast(shiftright(acc.counts[cast(e.word as int)], e.at) & {(1 << bits) - 1}L as int)"
    change = f"acc.total + {terms}[{count} + cast(e.by as int)] - {terms}[{count}]"
    step = (
        "(acc, e) -> named_struct("
        "'counts', transform(acc.counts, (c, k) -> if(k = e.word, c + e.by * shiftleft(1L, e.at), c)), "
        f"'held', acc.held + cast(e.by as int), 'total', {change}, "
        f"'least', if(acc.held + e.by = {WINDOW}, least(acc.least, {change}), acc.least))"
    )
    zero = f"named_struct('counts', array_repeat(0L, {-(-size // held)}), 'held', 0, 'total', 0D, 'least', 1e9D)"
    return f"aggregate({events}, {zero}, {step}, acc -> acc.least)"


def secret(kind: str) -> str:
    """SQL: candidates of one class of which some part reaches its entropy in some window.

    A candidate is cut at placeholders and at rows of signs; signs at the ends of what is left are
    taken off, and each part of WINDOW characters or more that is not allowed as a whole is judged.
    """
    letters, bits = CLASSES[kind]
    parts = f"transform(split(x.text, {quoted(CUT)}, -1), p -> regexp_replace(p, {quoted(STRIP)}, ''))"
    allowed = " or ".join(f"p rlike {quoted(pattern)}" for pattern in ALLOW)
    judged = f"exists(filter({parts}, p -> length(p) >= {WINDOW} and not ({allowed})), p -> {lowest_sum('p')} <= {least_sum(bits)!r}D)"
    return f"filter({spans(f'{letters}{{{WINDOW},}}', kind)}, x -> {judged})"


def scan(docs: DataFrame) -> DataFrame:
    """(doc_id, n_assign, n_access, n_hex, base_sha256, spans, found), one row per row of `docs` (doc_id BIGINT,
    text STRING, more ignored).

    found lists (start, end, kind, text) of all spans, in code points, end exclusive, by start and
    then kind; spans joins them as kind:start:end, base_sha256 is the digest of the base kinds so
    joined. Base kinds: assignments to names of secrets with a value of 12 characters or more,
    access keys, and runs of lower-case hex digits. The method adds candidates with a window of
    high entropy, of three character classes, placeholders left out; those that lie in a base span or in a span of an
    earlier class are not listed again.

    A null or empty text has no spans. Repeated rows and rows without a doc_id are scanned like any
    other. An empty table gives no rows. Patterns are looked for only in texts that pass a quick
    test; the work grows with a text's length.
    """
    body = F.coalesce(F.col("text").cast("string"), F.lit(""))
    rows = docs.select(F.col("doc_id").cast("bigint").alias("doc_id"), body.alias("body"))
    empty = f"cast(array() as {SPAN})"

    def when(hint: Column, sql: str) -> Column:
        return F.when(hint, F.expr(sql)).otherwise(F.expr(empty))

    assigned = f"filter({spans(ASSIGN, 'assign', 2)}, x -> length(x.text) >= {LEAST_ASSIGNED})"
    candidate = F.col("body").rlike(CANDIDATE_HINT)
    rows = rows.select(
        "doc_id",
        when(F.col("body").rlike(ASSIGN_HINT), assigned).alias("assign"),
        when(F.col("body").contains("AKIA"), spans(ACCESS, "access")).alias("access"),
        when(F.col("body").rlike("[0-9a-f]{16}"), spans(HEX, "hex")).alias("hex"),
        *(when(candidate, secret(kind)).alias(kind) for kind in CLASSES),
    )
    rows = rows.withColumn("base", F.array_sort(F.concat("assign", "access", "hex")))
    inside = "exists({}, y -> y.start <= x.start and x.end <= y.end)"
    known = ["base"]
    for kind in CLASSES:
        test = " or ".join(inside.format(name) for name in known)
        rows = rows.withColumn(kind, F.expr(f"filter({kind}, x -> not ({test}))"))
        known.append(kind)
    rows = rows.withColumn("all", F.array_sort(F.concat(*known)))
    names = "array(" + ", ".join(f"'{kind}'" for kind in KINDS) + ")"
    joined = "array_join(transform({}, x -> concat_ws(':', " + names + "[x.rank], x.start, x.end)), ',')"
    found = f"transform(all, x -> named_struct('start', x.start, 'end', x.end, 'kind', {names}[x.rank], 'text', x.text))"
    return rows.select(
        "doc_id",
        *(F.size(kind).cast("bigint").alias(f"n_{kind}") for kind in BASE),
        F.expr(f"sha2({joined.format('base')}, 256)").alias("base_sha256"),
        F.expr(joined.format("all")).alias("spans"),
        F.expr(found).alias("found"),
    )
