"""Secret scans with multipart credential linking, in DataFrame functions only.

Base spans are what the three patterns find, leftmost and non-overlapping. Beside them there are weak parts, each common
in clean text: access identifiers, long mixed strings that may be secrets, and endpoints. Within a document, parts are
joined by their intervals: an identifier is reported only within SCOPE characters of a secret, a mixed string only within
SCOPE of an identifier, an endpoint only when both are near it. All parts of a row stay in its arrays, so nothing is
shuffled and a row needs no key. The interval join is a sweep: ends and starts are sorted together, and running maxima over
them, by steps of doubled width, tell for all parts at once what is nearest, in n log n steps for n parts of a row.

Offsets are code points, end exclusive: the pieces between the matches and the matches themselves add up to them.

Defined results: null text counts as empty (no spans); each row is scanned for itself, whatever its id, copies alike. The
caller's columns travel in one struct, so none of their names clashes with those used here; columns of docs that are named
as those that scanned adds are replaced.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

#: The base patterns. The long runs are whole, so the least length may stand in the pattern itself; in the
#: assignment it may not, as a match that is too short still uses up its characters.
ASSIGN = r"""(?i)(password|passwd|secret|token|api_?key)["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)"""
ACCESS = r"AKIA[A-Z0-9]{12,}"
HEX = r"[0-9a-f]{32,}"
#: Weak parts.
NAME = r"""(?i)\b(client_?id|account_?id|access_?key_?id|tenant_?id|user_?name|login)["']?\x20*[:=]\x20*["']?([A-Za-z0-9@._-]+)"""
MIXED = r"(?<![A-Za-z0-9+/_-])(?=[A-Za-z+/_-]*[0-9])(?=[A-Z0-9+/_-]*[a-z])(?=[a-z0-9+/_-]*[A-Z])[A-Za-z0-9+/_-]{20,}"
ENDPOINT = r"https?://[A-Za-z0-9._~:/?#@!$&()*+,;=%-]+"
#: In the order in which kinds are listed; the number of the group with a least length, and that length.
KINDS = {"assign": (ASSIGN, 2, 8), "access": (ACCESS, 0, 16), "hex": (HEX, 0, 32), "id": (NAME, 2, 4), "key": (MIXED, 0, 20), "endpoint": (ENDPOINT, 0, 11)}
BASE = ("assign", "access", "hex")
SCOPE = 300
#: Weak kinds: of which of these groups some span must be near.
SECRETS, NAMES = ("assign", "hex", "key"), ("access", "id")
NEEDS = {"id": (SECRETS,), "key": (NAMES,), "endpoint": (SECRETS, NAMES)}
#: What a kind can't be without; a cheap test before its pattern.
HINT = {"endpoint": "://", "access": "AKIA"}

_NONE = "array<struct<start:int,end:int,kind:int>>"


def _doubled(values: str, start: int, join: str) -> str:
    """SQL for an array of the same length: join of (p, q) over all values up to each one, by steps of doubled width."""
    shifted = f"slice(concat(array_repeat({start}, cast(shiftleft(1, k) as int)), a), 1, size(a))"
    return f"aggregate(sequence(0, cast(ceil(log2(size({values}) + 1)) as int)), {values}, (a, k) -> zip_with(a, {shifted}, (p, q) -> {join}))"


def _spans(df: DataFrame, text: str, kind: str) -> DataFrame:
    """Adds the column _scan_kind: an array of (start, end, kind) of the matches that are long enough."""
    pattern, group, least = KINDS[kind]
    number = list(KINDS).index(kind)
    where = F.col(text).contains(HINT[kind]) if kind in HINT else F.lit(True)
    df = df.withColumn("_scan_hits", F.when(where, F.regexp_extract_all(text, F.lit(pattern), F.lit(0))))
    some = F.coalesce(F.size("_scan_hits") > 0, F.lit(False))
    pieces = F.transform(F.split(text, pattern, -1), lambda x: F.length(x))
    grouped = F.transform(F.regexp_extract_all(text, F.lit(pattern), F.lit(group)), lambda x: F.length(x)) if group else F.transform("_scan_hits", lambda x: F.length(x))
    df = df.withColumn("_scan_got", F.when(some, F.struct(pieces.alias("gap"), F.transform("_scan_hits", lambda x: F.length(x)).alias("len"), grouped.alias("part"))))
    # a step is the piece before a match and the match itself
    df = df.withColumn("_scan_steps", F.when(some, F.expr("zip_with(slice(_scan_got.gap, 1, size(_scan_got.len)), _scan_got.len, (a, b) -> a + b)")))
    df = df.withColumn("_scan_ends", F.when(some, F.expr(_doubled("_scan_steps", 0, "p + q"))))
    spans = F.expr(f"""filter(zip_with(zip_with(_scan_ends, _scan_got.len, (e, n) -> named_struct('start', e - n, 'end', e, 'kind', {number})), _scan_got.part, (x, n) -> if(n >= {least}, x, null)), x -> x is not null)""")
    return df.withColumn(f"_scan_{kind}", F.when(some, spans).otherwise(F.array().cast(_NONE))).drop("_scan_hits", "_scan_got", "_scan_steps", "_scan_ends")


#: Below every offset; ends and starts that count from the end are negative.
_LOW = -(2**31) + 1


def _latest(spans: str, at: str, value: str, parts: str, asks: str, ties: bool) -> str:
    """SQL: for each of parts (x), the largest value of those spans (y) whose at is below asks, or equal to it with ties."""
    first, second = (0, 1) if ties else (1, 0)
    events = f"array_sort(concat(transform({spans}, y -> struct({at} as at, {first} as turn, -1 as i, {value} as v)), transform({parts}, (x, i) -> struct({asks} as at, {second} as turn, i, {_LOW} as v))))"
    maxima = f"flatten(transform(array(transform(e, w -> w.v)), z -> {_doubled('z', _LOW, 'greatest(p, q)')}))"
    told = "transform(array_sort(filter(zip_with(e, m, (w, v) -> struct(w.i as i, v as v)), w -> w.i >= 0)), w -> w.v)"
    # an array of one element stands for a variable
    return f"flatten(transform(array({events}), e -> flatten(transform(array({maxima}), m -> {told}))))"


def _near(spans: str, parts: str) -> str:
    """SQL: for each of parts, whether one of spans lies within SCOPE of it and shares nothing with it."""
    before = _latest(spans, "y.end", "y.end", parts, "x.start", True)
    after = _latest(spans, "-y.start", "-y.start", parts, "-x.end", True)
    return f"zip_with(transform(zip_with({parts}, {before}, (x, v) -> x.start - {SCOPE} <= v), b -> b), zip_with({parts}, {after}, (x, v) -> -x.end - {SCOPE} <= v), (p, q) -> p or q)"


def _inside(spans: str, parts: str) -> str:
    """SQL: for each of parts, whether it shares something with one of spans."""
    return f"zip_with({parts}, {_latest(spans, 'y.start', 'y.end', parts, 'x.end', False)}, (x, v) -> v > x.start)"


def _text_of(spans: str, kinds: tuple[str, ...]) -> Column:
    names = "array(" + ", ".join(f"'{k}'" for k in kinds) + ")"
    return F.expr(f"array_join(transform({spans}, x -> concat({names}[x.kind], ':', x.start, ':', x.end)), ',')")


def _found(docs: DataFrame, text: Column) -> DataFrame:
    """(row, secret_n_assign, secret_n_access, secret_n_hex, secret_base, secret_spans): row holds the columns of docs."""
    df = docs.select(F.struct(*[F.col(f"`{c}`") for c in docs.columns]).alias("row"), F.coalesce(text.cast("string"), F.lit("")).alias("_scan_text"))
    for kind in KINDS:
        df = _spans(df, "_scan_text", kind)
    df = df.withColumn("_scan_base", F.expr("concat(_scan_assign, _scan_access, _scan_hex)"))
    for group, kinds in (("secrets", SECRETS), ("names", NAMES)):
        df = df.withColumn(f"_scan_{group}", F.expr("concat(" + ", ".join(f"_scan_{k}" for k in kinds) + ")"))
    for kind, needs in NEEDS.items():
        part, groups = f"_scan_{kind}", [f"_scan_{'secrets' if n is SECRETS else 'names'}" for n in needs]
        some = F.expr(" and ".join(f"size({g}) > 0" for g in [part, *groups]))
        # what was told is zipped to the parts: a column that a lambda looks into would be computed for each of them
        for g in groups:
            df = df.withColumn(part, F.when(some, F.expr(f"filter(zip_with({part}, {_near(g, part)}, (x, b) -> if(b, x, null)), x -> x is not null)")).otherwise(F.array().cast(_NONE)))
        if kind != "endpoint":  # what a base span tells already isn't told again
            told = F.expr(f"filter(zip_with({part}, {_inside('_scan_base', part)}, (x, b) -> if(b, null, x)), x -> x is not null)")
            df = df.withColumn(part, F.when(F.expr(f"size({part}) > 0 and size(_scan_base) > 0"), told).otherwise(F.col(part)))
        df = df.withColumnRenamed(part, f"_scan_linked_{kind}")
    # array_sort orders by start, then end; kind must come before end where one start has several spans
    order = lambda c: F.transform(F.array_sort(F.transform(c, lambda x: F.struct(x["start"].alias("start"), x["kind"].alias("kind"), x["end"].alias("end")))), lambda x: F.struct(x["start"].alias("start"), x["end"].alias("end"), x["kind"].alias("kind")))
    spans = F.expr("concat(_scan_base, _scan_linked_id, _scan_linked_key, _scan_linked_endpoint)")
    return df.select("row", *[F.size(f"_scan_{k}").cast("long").alias(f"secret_n_{k}") for k in BASE], order(F.col("_scan_base")).alias("secret_base"), order(spans).alias("secret_spans"))


def scanned(docs: DataFrame, text_col: str = "text") -> DataFrame:
    """docs with secret_spans, an array of (start, end, kind number) by start and kind, secret_base, those of the base kinds, and their numbers."""
    found = _found(docs, F.col(f"`{text_col}`"))
    made = found.columns[1:]
    return found.select(*[F.col(f"row.`{c}`") for c in docs.columns if c.lower() not in made], *made)


def report(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(doc_id, n_assign, n_access, n_hex, base_sha256, spans, n_linked) of each row."""
    found = scanned(docs.select(F.col(id_col).alias("doc_id"), F.col(text_col).alias("text")))
    kinds = tuple(KINDS)
    return found.select("doc_id", *[F.col(f"secret_n_{k}").alias(f"n_{k}") for k in BASE], F.sha2(_text_of("secret_base", kinds).cast("binary"), 256).alias("base_sha256"), _text_of("secret_spans", kinds).alias("spans"), (F.size("secret_spans") - F.size("secret_base")).cast("long").alias("n_linked"))


def redacted(docs: DataFrame, text_col: str = "text", by: str = "[SECRET]") -> DataFrame:
    """docs with every span of text_col but endpoints replaced; overlapping spans become one. Rows without spans stay as they are.

    What stands between the spans is cut out of pieces of the text, of as many spans each as there are pieces: the cost of a
    long text with many spans grows with their root.
    """
    text, endpoint = f"row.`{text_col}`", list(KINDS).index("endpoint")
    df = _found(docs, F.col(f"`{text_col}`")).withColumn("hidden", F.filter("secret_spans", lambda x: x["kind"] != endpoint))
    some = F.size("hidden") > 0
    # how far the spans before each one reach, and the gaps that begin there and end where a span starts
    reach = _latest("hidden", "y.start", "y.end", "hidden", "x.start", False)
    df = df.withColumn("gaps", F.when(some, F.expr(f"filter(zip_with(hidden, {reach}, (x, r) -> struct(greatest(r, 0) as at, x.start as to)), g -> g.to >= g.at)")))
    inner = f"concat(substring(piece, g.at - c[0].at + 1, g.to - g.at), {_quoted(by)})"
    joined = f"array_join(flatten(transform(array(substring(t, c[0].at + 1, c[size(c) - 1].to - c[0].at)), piece -> transform(c, g -> {inner}))), '')"
    blocks = "transform(sequence(0, cast(ceil(size(all) / w) as int) - 1), b -> slice(all, b * w + 1, w))"
    # arrays of one element stand for variables: the text, all gaps, and how many go together
    made = f"flatten(transform(array(v.all), all -> flatten(transform(array(v.t), t -> flatten(transform(array(cast(ceil(sqrt(size(all))) as int)), w -> transform({blocks}, c -> {joined})))))))"
    pieces = f"array_join(flatten(transform(array(struct({text} as t, gaps as all)), v -> {made})), '')"
    rest = f"substring({text}, array_max(transform(hidden, x -> x.end)) + 1)"
    out = F.when(some, F.expr(f"concat({pieces}, {rest})")).otherwise(F.col(text))
    return df.select(*[out.alias(c) if c == text_col else F.col(f"row.`{c}`") for c in docs.columns])


def _quoted(text: str) -> str:
    escaped = text.replace("\\", "\\\\").replace("'", "\\'")
    return f"'{escaped}'"
