"""Secret scan with multipart credential linking, in SQL functions only.

Base kinds (spans are code points, end exclusive; matches are leftmost and do
not overlap within a kind): ``assign``, ``access`` and ``hex``. Spark has no
function for match positions, so they are the running lengths of the pieces
that ``split`` and ``regexp_extract_all`` cut with the same pattern.

Linking. Weak candidates are too common to report alone: account names
(``user``), opaque values without a keyword (``opaque``) and endpoints
(``endpoint``). Parts are identifiers (access, user), secrets (assign, hex,
opaque) and endpoints. Within the scope of a weak candidate (gaps of at most
``scope`` code points) the other parts are interval-joined to it by a sorted
sweep, and it is reported only beside its complements:

* ``user``: a secret is in scope;
* ``opaque``: an identifier is in scope (opaque values that overlap a base
  span are no candidates);
* ``endpoint``: an identifier and a secret are in scope.

Opaque values count as a user's or endpoint's secret only when they are
linked themselves. Whether a value is opaque is decided by its own characters.
Very long texts: positions take n ^ 1.5 steps for n matches, the join n log n. Everything happens within a row, so there is no shuffle,
and equal rows give equal results. Null text counts as empty; an empty text
has no spans and the digest of the empty string; an empty table gives an
empty result. Extra columns are kept out of the way: only the id is returned.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import masked, unmasked

# Fixed patterns of the base kinds. The two single-class runs carry their
# least length: a run that is too short can hold no match that is long enough.
ASSIGN = (r"""(?i:password|passwd|secret|token|api_?key)["']?\x20*[:=]\x20*["']?"""
          r"""([A-Za-z0-9+/_.=-]+)""")
ACCESS = r"AKIA[A-Z0-9]{16,}"
HEX = r"[0-9a-f]{24,}"
ASSIGN_LEAST = 6

# Weak candidates of the linking method.
USER = (r"""(?i:\b(?:user(?:name)?|login|account|client_?id|access_?key_?id))["']?\x20*[:=]\x20*["']?"""
        r"""([A-Za-z0-9_.@-]{3,})""")
OPAQUE = (r"(?<![A-Za-z0-9+/_-])(?=[A-Za-z+/_-]*[0-9])(?=[a-z0-9+/_-]*[A-Z])(?=[A-Z0-9+/_-]*[a-z])"
          r"[A-Za-z0-9+/_-]{32,}")
ENDPOINT = r"""\b[a-z][a-z0-9+.-]{1,15}://[A-Za-z0-9_.:@%-]+"""

#: Reporting order of kinds that start at the same place.
KINDS = ("assign", "access", "hex", "user", "opaque", "endpoint")
SCOPE = 200


def _let(value: Column, body: Callable[[Column], Column]) -> Column:
    """``body`` of ``value`` computed once: inside a lambda a column is computed per element."""
    return F.element_at(F.transform(F.array(value), body), 1)


_SPANS = "array<struct<start:int,end:int,size:int>>"


def _none() -> Column:
    return F.array().cast(_SPANS)


def _run_up(lengths: Column) -> Column:
    """Spans of consecutive (gap, n, size), from 0, and where they end."""
    return F.aggregate(
        lengths, F.struct(F.lit(0).alias("at"), _none().alias("out")),
        lambda s, x: F.struct((s["at"] + x["gap"] + x["n"]).alias("at"),
                              F.concat(s["out"], F.array(F.struct(
                                  (s["at"] + x["gap"]).alias("start"),
                                  (s["at"] + x["gap"] + x["n"]).alias("end"),
                                  x["size"].alias("size")))).alias("out")))


def _placed(lengths: Column) -> Column:
    """The same for any number: an array that grows is copied at each step, so
    blocks of about the square root are run up, then shifted by the blocks before."""

    def blocks(all_: Column) -> Column:
        step = F.greatest(F.ceil(F.sqrt(F.size(all_))).cast("int"), F.lit(1))
        cut = F.transform(F.sequence(F.lit(0), F.floor((F.size(all_) - 1) / step).cast("int")), lambda i: _run_up(F.slice(all_, i * step + 1, step)))
        return _let(cut, shifted)

    def shifted(parts: Column) -> Column:
        ends = F.aggregate(parts, F.struct(F.lit(0).alias("at"), F.array().cast("array<int>").alias("out")),
                           lambda s, x: F.struct((s["at"] + x["at"]).alias("at"), F.concat(s["out"], F.array(s["at"])).alias("out")),
                           lambda s: s["out"])
        moved = F.zip_with(parts, ends, lambda p, by: F.transform(p["out"], lambda x: F.struct(
            (x["start"] + by).alias("start"), (x["end"] + by).alias("end"), x["size"].alias("size"))))
        return F.flatten(moved)

    return _let(lengths, lambda x: F.when(F.size(x) > 0, blocks(x)).otherwise(_none()))


def match_spans(text: Column, pattern: str, group: int = 0) -> Column:
    """array<struct<start, end, size>> of all matches; ``size`` is the length
    of capture group ``group``."""
    gaps = F.split(text, pattern, -1)
    found = F.regexp_extract_all(text, F.lit(pattern), F.lit(0))
    inner = F.regexp_extract_all(text, F.lit(pattern), F.lit(group)) if group else found
    pairs = F.arrays_zip(found.alias("m"), inner.alias("g"))
    # The gap after the last match has no partner; it falls away.
    lengths = F.filter(F.zip_with(gaps, pairs, lambda a, b: F.struct(
        F.length(a).alias("gap"), F.length(b["m"]).alias("n"), F.length(b["g"]).alias("size"))), lambda x: x["n"].isNotNull())
    return F.when(text.rlike(pattern), _placed(lengths)).otherwise(_none())


def _below(values: Column, bounds: Column, inclusive: bool) -> Column:
    """For each of the rising ``bounds``: how many ``values`` are below it (or
    equal). Both are sorted together; a bound's place less the bounds before it
    is the answer."""
    first, second = (0, 1) if inclusive else (1, 0)
    both = F.array_sort(F.concat(F.transform(values, lambda v: F.struct(v.alias("v"), F.lit(first).alias("t"), F.lit(False).alias("b"))),
                                 F.transform(bounds, lambda v: F.struct(v.alias("v"), F.lit(second).alias("t"), F.lit(True).alias("b")))))
    places = F.filter(F.transform(both, lambda x, i: F.when(x["b"], i)), lambda i: i.isNotNull())
    return F.transform(places, lambda i, r: i - r)


def _met(spans: Column, parts: Column, scope: int | None) -> Column:
    """How many ``parts`` lie within ``scope`` of each span (None: overlap it):
    those that start before its window ends, less those that end before it
    begins. A sorted sweep; ``spans`` rise and do not overlap."""
    reach = 0 if scope is None else scope
    started = _below(F.transform(parts, lambda p: p["start"]), F.transform(spans, lambda a: a["end"] + reach), scope is not None)
    ended = _below(F.transform(parts, lambda p: p["end"]), F.transform(spans, lambda a: a["start"] - reach), scope is None)
    return F.zip_with(started, ended, lambda s, e: s - e)


def _chosen(spans: Column, keep: Column) -> Column:
    paired = F.zip_with(spans, keep, lambda a, k: F.struct(a.alias("a"), k.alias("k")))
    return F.transform(F.filter(paired, lambda x: x["k"]), lambda x: x["a"])


def _near(spans: Column, parts: Column, scope: int) -> Column:
    """Spans with a part within ``scope``."""
    return _chosen(spans, F.transform(_met(spans, parts, scope), lambda n: n > 0))


def _clear(spans: Column, base: Column) -> Column:
    """Spans that overlap no base span."""
    return _chosen(spans, F.transform(_met(spans, base, None), lambda n: n == 0))


def _tagged(spans: Column, kind: str) -> Column:
    k = KINDS.index(kind)
    return F.transform(spans, lambda s: F.struct(s["start"].alias("start"), F.lit(k).alias("kind"), s["end"].alias("end")))


def _shown(spans: Column) -> Column:
    names = F.array(*map(F.lit, KINDS))
    return F.concat_ws(",", F.transform(spans, lambda s: F.concat_ws(
        ":", F.element_at(names, s["kind"] + 1), s["start"].cast("string"), s["end"].cast("string"))))


def with_secrets(df: DataFrame, text_col: str = "text", scope: int = SCOPE, prefix: str = "__s_") -> DataFrame:
    """``df`` with (each name behind ``prefix``) ``n_assign``, ``n_access``,
    ``n_hex``, ``base`` and ``all``: arrays of (start, kind index, end)."""
    p = prefix
    text = F.coalesce(F.col(f"`{text_col}`").cast("string"), F.lit(""))
    df = df.withColumn(f"{p}text", text)
    t = F.col(f"{p}text")
    df = df.withColumns({
        f"{p}assign": F.filter(match_spans(t, ASSIGN, 1), lambda s: s["size"] >= ASSIGN_LEAST),
        f"{p}access": match_spans(t, ACCESS), f"{p}hex": match_spans(t, HEX)})
    strong = F.concat(f"{p}assign", f"{p}access", f"{p}hex")
    # Opaque values and users need a part beside them; texts without any are not searched.
    df = df.withColumns({
        f"{p}strong": strong,
        f"{p}users": match_spans(t, USER, 1)})
    none = _none()
    ids = F.concat(f"{p}access", f"{p}users")
    df = df.withColumn(f"{p}opaques", F.when(F.size(ids) > 0, _clear(match_spans(t, OPAQUE), F.col(f"{p}strong"))).otherwise(none))
    df = df.withColumn(f"{p}opaque", _near(F.col(f"{p}opaques"), ids, scope))
    df = df.withColumn(f"{p}secret", F.concat(f"{p}assign", f"{p}hex", f"{p}opaque"))
    df = df.withColumn(f"{p}user", _near(F.col(f"{p}users"), F.col(f"{p}secret"), scope))
    linked = F.concat(f"{p}access", f"{p}user")
    ready = (F.size(linked) > 0) & (F.size(f"{p}secret") > 0)
    df = df.withColumn(f"{p}endpoint", F.when(ready, _near(_near(match_spans(t, ENDPOINT), linked, scope), F.col(f"{p}secret"), scope)).otherwise(none))
    base = F.array_sort(F.concat(*[_tagged(F.col(f"{p}{k}"), k) for k in KINDS[:3]]))
    every = F.array_sort(F.concat(*[_tagged(F.col(f"{p}{k}"), k) for k in KINDS]))
    df = df.withColumns({f"{p}n_{k}": F.size(f"{p}{k}").cast("long") for k in KINDS[:3]}
                        | {f"{p}base": base, f"{p}all": every})
    return df.drop(*[f"{p}{x}" for x in ("assign", "access", "hex", "strong", "users", "opaques", "opaque",
                                         "secret", "user", "endpoint")])


def scan(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", scope: int = SCOPE) -> DataFrame:
    """(id, n_assign, n_access, n_hex, base_sha256, spans, n_linked) per row."""
    df = with_secrets(docs.select(F.col(f"`{id_col}`").alias("__id"), F.col(f"`{text_col}`").alias("__t")), "__t", scope)
    return df.select(
        F.col("__id").alias(id_col), F.col("__s_n_assign").alias("n_assign"), F.col("__s_n_access").alias("n_access"),
        F.col("__s_n_hex").alias("n_hex"), F.sha2(_shown(F.col("__s_base")), 256).alias("base_sha256"),
        _shown(F.col("__s_all")).alias("spans"),
        (F.size("__s_all") - F.size("__s_base")).cast("long").alias("n_linked"))


def redact(docs: DataFrame, text_col: str = "text", mark: str = "[SECRET]", scope: int = SCOPE) -> DataFrame:
    """``docs`` with every reported secret cut from the text: base spans and
    linked opaque values become ``mark`` (spans that overlap become one).
    Linked users and endpoints stay; alone they open nothing. Null text stays
    null, and other columns come back unchanged, whatever their names."""
    docs, names = masked(docs)
    text_col = names[text_col]
    df = with_secrets(docs, text_col, scope)
    hidden = F.filter("__s_all", lambda s: s["kind"].isin(*[KINDS.index(k) for k in ("assign", "access", "hex", "opaque")]))
    start = F.struct(F.lit(0).alias("at"), F.lit("").alias("out"))
    text = F.col("__s_text")
    cut = F.aggregate(
        hidden, start,
        lambda a, s: F.when(s["start"] >= a["at"], F.struct(
            s["end"].alias("at"), F.concat(a["out"], F.substr(text, a["at"] + 1, s["start"] - a["at"]), F.lit(mark)).alias("out")))
        .otherwise(F.struct(F.greatest(a["at"], s["end"]).alias("at"), a["out"].alias("out"))),
        lambda a: F.concat(a["out"], F.substr(text, a["at"] + 1)))
    df = df.withColumn(text_col, F.when(F.size(hidden) > 0, cut).otherwise(F.col(text_col)))
    return df.select(*unmasked(names))
