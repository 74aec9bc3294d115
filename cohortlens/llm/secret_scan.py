"""Secret scans with multipart credential linking, in DataFrame functions only.

Strong spans are reported wherever they stand: ``assign`` (a secret-like name
with a value of 6 characters or more), ``access`` (access key ids of 20) and
``hex`` (24 hex digits or more). A credential usually has several parts: an
identifier, a secret and an endpoint. Weak candidates for these (``id``: a
login-like name with a value; ``key``: a run of 32 or more base-64 characters
with upper case, lower case and digits; ``endpoint``: a URL or a host-like name
with a value) mean little alone. They are joined by interval: a weak candidate
is reported only if a complementary part lies within ``scope`` code points of
it. An id needs a secret (assign, hex, key), a key needs an id or an endpoint
(or an access key id), an endpoint needs a secret. Weak candidates that overlap
a strong span are part of it and not reported again.

Everything is row-local: no shuffle, no Python. Positions are code points, end
exclusive; matches of a kind are leftmost and do not overlap.

Defined results: NULL text counts as empty (no spans, sha256 of the empty
string); rows with a NULL or repeated id are scanned like any other; an empty
table gives no rows; further columns of the input are not read.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

KINDS = ["assign", "access", "hex", "id", "key", "endpoint"]
STRONG = 3
SCOPE = 200
_SPAN = "array<struct<start:int,kind:int,finish:int>>"


def either_case(word: str) -> str:
    return "".join(f"[{c.upper()}{c}]" if c.isalpha() else c for c in word)


def _named(names: str, value: str) -> str:
    """A name out of ``names`` (letters in either case), then its value."""
    return "(" + "|".join(map(either_case, names.split("|"))) + ")" + r"""["']?\x20*[:=]\x20*["']?""" + f"({value})"


#: Patterns by kind: (pattern, group whose length counts, least length)
PATTERNS = {
    "assign": (_named("password|passwd|secret|token|api_?key", "[A-Za-z0-9+/_.=-]+"), 2, 6),
    "access": ("AKIA[A-Z0-9]+", 0, 20),
    "hex": ("[0-9a-f]+", 0, 24),
    "id": (_named("username|user|login|account|client_?id|access_?key_?id", "[A-Za-z0-9@._-]+"), 2, 3),
    "key": ("[A-Za-z0-9+/]+", 0, 32),
    "endpoint": (r"""[A-Za-z][A-Za-z0-9+.-]*://[^\x09-\x0D\x20"'<>]+|""" + "(?:" + "|".join(map(either_case, ["host", "endpoint", "server"]))
                 + r""")["']?\x20*[:=]\x20*["']?[A-Za-z0-9._:/-]+""", 0, 8),
}
#: Longest cheap test that holds for every text with a span of the kind.
PREFILTER = {"assign": PATTERNS["assign"][0], "access": "AKIA[A-Z0-9]{16}", "hex": "[0-9a-f]{24}",
             "id": PATTERNS["id"][0], "key": "[A-Za-z0-9+/]{32}", "endpoint": PATTERNS["endpoint"][0]}


def _spans(text: Column, kind: str) -> Column:
    """All spans of one kind, by start: the text is split at the matches, and
    the lengths of the parts add up to the positions."""
    pattern, group, least = PATTERNS[kind]
    parts = F.arrays_zip(F.split(text, pattern, -1).alias("gap"),
                         F.regexp_extract_all(text, F.lit(pattern), F.lit(0)).alias("hit"),
                         F.regexp_extract_all(text, F.lit(pattern), F.lit(group)).alias("part"))

    def step(acc: Column, x: Column) -> Column:
        start = acc["at"] + F.length(x["gap"])
        end = start + F.coalesce(F.length(x["hit"]), F.lit(0))
        good = F.length(x["part"]) >= least
        if kind == "key":
            good &= x["hit"].rlike("[A-Z]") & x["hit"].rlike("[a-z]") & x["hit"].rlike("[0-9]")
        span = F.struct(start.alias("start"), F.lit(KINDS.index(kind)).alias("kind"), end.alias("finish"))
        return F.struct(end.alias("at"), F.when(good, F.concat(acc["out"], F.array(span)))
                        .otherwise(acc["out"]).alias("out"))

    none = F.array().cast(_SPAN)
    found = F.aggregate(parts, F.struct(F.lit(0).alias("at"), none.alias("out")), step, lambda acc: acc["out"])
    return F.when(text.rlike(PREFILTER[kind]), found).otherwise(none)


def _near(x: Column, others: Column, scope: int) -> Column:
    """True if a span of ``others`` lies within ``scope`` of ``x``."""
    return F.exists(others, lambda y: (y["start"] <= x["finish"] + scope) & (y["finish"] + scope >= x["start"]))


def _linked(kind: str, partner: str, scope: int) -> Column:
    return F.filter(kind, lambda x: _near(x, F.col(partner), scope))


def _digest_text(spans: Column) -> Column:
    names = F.array(*map(F.lit, KINDS))
    return F.array_join(F.transform(spans, lambda s: F.concat_ws(
        ":", F.element_at(names, s["kind"] + 1), s["start"].cast("string"), s["finish"].cast("string"))), ",")


def scan(docs: DataFrame, scope: int = SCOPE, id_col: str = "doc_id", column: str = "text") -> DataFrame:
    """(id_col, spans): every document's spans {start, kind, finish} (kind by
    position in KINDS), strong ones and linked weak ones, by start, then kind."""
    return _scan(docs.select(F.struct(id_col).alias("_row"), F.coalesce(F.col(column), F.lit("")).alias("_text")),
                 scope).select(F.col("_row")[id_col].alias(id_col), "spans")


def redact(docs: DataFrame, scope: int = SCOPE, column: str = "text", mark: str = "[secret]") -> DataFrame:
    """``docs`` with every span of ``column`` replaced by ``mark`` (overlapping
    spans by one); all columns are kept, texts without spans unchanged."""
    names = docs.columns
    found = _scan(docs.select(F.struct(*[F.col(f"`{c}`") for c in names]).alias("_row"),
                              F.coalesce(F.col(column), F.lit("")).alias("_text")), scope)
    text = F.col("_row")[column]

    def step(acc: Column, s: Column) -> Column:
        before = F.substring(text, acc["at"] + 1, F.greatest(s["start"] - acc["at"], F.lit(0)))
        fresh = s["start"] >= acc["at"]
        return F.struct(F.greatest(acc["at"], s["finish"]).alias("at"),
                        F.when(fresh, F.concat(acc["out"], before, F.lit(mark))).otherwise(acc["out"]).alias("out"))

    clean = F.aggregate("spans", F.struct(F.lit(0).alias("at"), F.lit("").alias("out")), step,
                        lambda acc: F.concat(acc["out"], F.substring(text, acc["at"] + 1, F.length(text))))
    return found.select(*[(F.when(F.size("spans") > 0, clean).otherwise(text) if c == column else F.col("_row")[c]).alias(c)
                          for c in names])


def _scan(texts: DataFrame, scope: int) -> DataFrame:
    """(_row, spans) of a table (_row, _text)."""
    def row(df: DataFrame, **columns: Column) -> DataFrame:
        # one generated row each: a border that keeps expressions from being evaluated again for every use
        return df.select("_row", F.explode(F.array(F.struct(*[c.alias(k) for k, c in columns.items()]))).alias("s")).select(
            "_row", "s.*")

    found = row(texts, **{k: _spans(F.col("_text"), k) for k in KINDS})
    strong = {k: F.col(k) for k in KINDS[:STRONG]}
    found = row(found, strong=F.concat(*strong.values()), **{k: F.col(k) for k in KINDS})
    found = row(found, strong=F.col("strong"), **strong, **{
        k: F.filter(k, lambda x: ~_near(x, F.col("strong"), -1)) for k in KINDS[STRONG:]})
    secrets, names = F.concat("assign", "hex", "key"), F.concat("access", "id", "endpoint")
    found = row(found, strong=F.col("strong"), secrets=secrets, names=names, **{k: F.col(k) for k in KINDS[STRONG:]})
    partner = {"id": "secrets", "key": "names", "endpoint": "secrets"}
    linked = [_linked(k, other, scope) for k, other in partner.items()]
    return row(found, spans=F.array_sort(F.concat("strong", *linked)))


def digest(spans: DataFrame, id_col: str = "doc_id") -> DataFrame:
    """Counts and digests of ``scan``'s spans."""
    base = F.filter("spans", lambda s: s["kind"] < STRONG)
    count = lambda k: F.size(F.filter("spans", lambda s: s["kind"] == KINDS.index(k))).cast("long")
    return spans.select(id_col, *[count(k).alias(f"n_{k}") for k in KINDS[:STRONG]],
                        F.sha2(_digest_text(base), 256).alias("base_sha256"), _digest_text(F.col("spans")).alias("spans"),
                        *[count(k).alias(f"n_{k}") for k in KINDS[STRONG:]])


# -- the same in DuckDB SQL -------------------------------------------------------

def duckdb_sql(source: str = "documents", scope: int = SCOPE) -> str:
    quoted = lambda s: "'" + s.replace("'", "''") + "'"

    def spans(kind: str) -> str:
        pattern, group, least = PATTERNS[kind]
        good = f"len(parts[i]) >= {least}"
        if kind == "key":
            good += " AND regexp_matches(hits[i], '[A-Z]') AND regexp_matches(hits[i], '[a-z]') AND regexp_matches(hits[i], '[0-9]')"
        return f"""{kind}_m AS (
  SELECT n, string_split_regex(t, {quoted(pattern)}) AS gaps, regexp_extract_all(t, {quoted(pattern)}, 0) AS hits,
         regexp_extract_all(t, {quoted(pattern)}, {group}) AS parts FROM d WHERE regexp_matches(t, {quoted(PREFILTER[kind])})),
{kind}_e AS (SELECT n, unnest(range(1, len(hits) + 1)) AS i, gaps, hits, parts FROM {kind}_m),
{kind} AS (
  SELECT n, {KINDS.index(kind)} AS kind, e - length(hits[i]) AS s, e FROM (
    SELECT *, sum(length(gaps[i]) + length(hits[i])) OVER (PARTITION BY n ORDER BY i) AS e FROM {kind}_e)
  WHERE {good})"""

    near = lambda a, b, w: f"{b}.n = {a}.n AND {b}.s <= {a}.e + {w} AND {b}.e + {w} >= {a}.s"
    weak = lambda k: (f"{k}_w AS (SELECT * FROM {k} WHERE NOT EXISTS (SELECT 1 FROM strong WHERE "  # noqa: E731
                      f"{near(k, 'strong', -1)}))")
    linked = lambda k, o: (f"SELECT * FROM {k}_w WHERE EXISTS (SELECT 1 FROM {o} WHERE {near(k + '_w', o, scope)})")
    text = lambda cond: (f"coalesce(string_agg(names[kind + 1] || ':' || s || ':' || e, ',' "  # noqa: E731
                         f"ORDER BY s, kind) FILTER ({cond}), '')")
    counts = ", ".join(f"count(*) FILTER (kind = {i}) AS n_{k}" for i, k in enumerate(KINDS))
    return f"""
WITH d AS (SELECT row_number() OVER () AS n, doc_id, coalesce(text, '') AS t FROM {source}),
{", ".join(spans(k) for k in KINDS)},
strong AS (SELECT * FROM assign UNION ALL SELECT * FROM access UNION ALL SELECT * FROM hex),
{weak('id')}, {weak('key')}, {weak('endpoint')},
secrets AS (SELECT * FROM assign UNION ALL SELECT * FROM hex UNION ALL SELECT * FROM key_w),
names AS (SELECT * FROM access UNION ALL SELECT * FROM id_w UNION ALL SELECT * FROM endpoint_w),
every AS (SELECT * FROM strong UNION ALL {linked('id', 'secrets')} UNION ALL {linked('key', 'names')}
          UNION ALL {linked('endpoint', 'secrets')}),
g AS (SELECT n, {counts}, {text(f'kind < {STRONG}')} AS base, {text('true')} AS spans
      FROM (SELECT *, {[*KINDS]} AS names FROM every) GROUP BY n)
SELECT doc_id, {", ".join(f"coalesce(n_{k}, 0) AS n_{k}" for k in KINDS)},
       sha256(coalesce(base, '')) AS base_sha256, coalesce(spans, '') AS spans
FROM d LEFT JOIN g USING (n)"""
