"""Secret scan by corpus-wide ownership frequency, in DataFrame functions only.

A scan finds candidate spans in every text.  The hash of each candidate's value is then
counted over the corpus by distinct repositories and owners: a value that many owners carry
is a widely copied example, one that few owners carry looks like a live credential.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from pricetrail.llm.common import stored

# Fixed patterns of the contract.  ``access`` and ``hex`` are runs of one class, so asking for
# the length inside the pattern gives the matches that pass; an ``assign`` match that fails
# still consumes its text, so its length is asked afterwards.
ASSIGN = (
    r"""(?i:password|passwd|secret|token|api_?key)["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)"""
)
ASSIGN_VALUE = 12
ACCESS = r"AKIA[A-Z0-9]{14,}"
HEX = r"[0-9a-f]{16,}"
BASE_KINDS = ("assign", "access", "hex")

# The added kind: long unbroken tokens that mix letters and digits.
BARE = r"[A-Za-z0-9+/_-]{20,}+"
BARE_KIND = "bare"
KINDS = (*BASE_KINDS, BARE_KIND)
SPAN_TYPE = "array<struct<start:int,rank:int,stop:int,value:string>>"
RUN = 256  # spans of a long text that are looked at together


def _let(value: Column, body) -> Column:
    """``body(value)`` with the value computed once; a lambda computes what it mentions for every element."""
    return F.element_at(F.transform(F.array(value), body), 1)


def _blocks(items: Column) -> Column:
    """An array in runs of ``RUN`` elements."""

    def cut(v: Column) -> Column:
        first = F.sequence(F.lit(1), F.size(v), F.lit(RUN))
        return F.when(F.size(v) > 0, F.transform(first, lambda i: F.slice(v, i, F.lit(RUN))))

    return _let(items, cut)


def _running(values: Column, merge) -> Column:
    """For each element of an array of counts: ``merge`` of all up to it, run by run."""
    zero = F.lit(0)

    def within(runs: Column) -> Column:
        totals = F.transform(runs, lambda run: F.aggregate(run, zero, merge))

        def one(before: Column) -> Column:
            def up_to(run: Column, b: Column) -> Column:
                start = F.element_at(before, b + 1)
                return F.transform(run, lambda _, i: F.aggregate(F.slice(run, F.lit(1), i + 1), start, merge))

            return F.flatten(F.transform(runs, up_to))

        return _let(totals, lambda t: _let(_before(t, merge), one))

    return F.coalesce(_let(_blocks(values), within), F.array().cast("array<int>"))


def _before(totals: Column, merge) -> Column:
    return F.transform(totals, lambda _, b: F.aggregate(F.slice(totals, F.lit(1), b), F.lit(0), merge))


def _spans(text: Column, pattern: str, rank: int, group: int = 0) -> Column:
    """All matches as (start, rank, stop, value), in code points; ``value`` is a group's text."""
    whole = F.regexp_extract_all(text, F.lit(pattern), F.lit(0))
    value = F.regexp_extract_all(text, F.lit(pattern), F.lit(group)) if group else whole
    found = F.struct(F.split(text, pattern, -1).alias("pieces"), whole.alias("whole"), value.alias("value"))

    def all_spans(m: Column) -> Column:
        steps = F.transform(m["whole"], lambda w, i: F.length(w) + F.length(F.element_at(m["pieces"], i + 1)))
        stops = _running(steps, lambda a, x: a + x)
        matches = F.arrays_zip(stops.alias("stop"), m["whole"].alias("whole"), m["value"].alias("value"))
        return F.transform(
            matches,
            lambda s: F.struct(
                (s["stop"] - F.length(s["whole"])).alias("start"),
                F.lit(rank).alias("rank"),
                s["stop"].alias("stop"),
                s["value"].alias("value"),
            ),
        )

    none = F.array().cast(SPAN_TYPE)
    return F.when(text.rlike(pattern), _let(found, all_spans)).otherwise(none)


def _base_spans(text: Column) -> Column:
    assign = F.filter(_spans(text, ASSIGN, 0, 1), lambda s: F.length(s["value"]) >= ASSIGN_VALUE)
    return F.array_sort(F.concat(assign, _spans(text, ACCESS, 1), _spans(text, HEX, 2)))


def _bare_spans(text: Column) -> Column:
    mixed = lambda s: s["value"].rlike("[0-9]") & s["value"].rlike("[A-Za-z]")
    return F.filter(_spans(text, BARE, len(BASE_KINDS)), mixed)


def _apart(spans: Column, others: Column) -> Column:
    """The spans that touch none of ``others``, which are sorted; only runs within reach are looked through."""

    def touches(s: Column, o: Column) -> Column:
        return (o["start"] < s["stop"]) & (s["start"] < o["stop"])

    def whole_run(run: Column) -> Column:
        stops = F.transform(run, lambda o: o["stop"])
        return F.struct(run[0]["start"].alias("start"), F.array_max(stops).alias("stop"), run.alias("spans"))

    def free_of(runs: Column) -> Column:
        def hit(s: Column) -> Column:
            return F.exists(runs, lambda r: touches(s, r) & F.exists(r["spans"], lambda o: touches(s, o)))

        return F.filter(spans, lambda s: ~hit(s))

    both = (F.size(spans) > 0) & (F.size(others) > 0)
    return F.when(both, _let(F.transform(_blocks(others), whole_run), free_of)).otherwise(spans)


def spans_text(spans: Column) -> Column:
    """kind:start:end of each span, by start and then kind, comma-joined."""
    kinds = F.array(*[F.lit(k) for k in KINDS])
    one = lambda s: F.concat_ws(":", F.element_at(kinds, s["rank"] + 1), s["start"], s["stop"])
    return F.concat_ws(",", F.transform(spans, one))


def scan(docs: DataFrame, text: str = "text") -> DataFrame:
    """``docs`` as a struct ``doc`` with its candidate spans, ``base`` and ``bare``.

    Bare tokens that touch a base span are left out.  Null texts have no spans.
    """
    body = F.coalesce(F.col(text), F.lit(""))
    found = docs.select(F.struct("*").alias("doc"), body.alias("body"))
    found = found.select("doc", _base_spans(F.col("body")).alias("base"), _bare_spans(F.col("body")).alias("bare"))
    return found.withColumn("bare", _apart(F.col("bare"), F.col("base")))


def ownership(found: DataFrame, owner: Column, repository: Column) -> DataFrame:
    """For each candidate hash: distinct owners and repositories; a null counts as one of its own.

    Rows are combined before each shuffle, first by hash, owner and repository, so a value
    that everybody carries never gathers in one task.
    """
    seen = found.select(
        F.explode(F.concat("base", "bare")).alias("span"), owner.alias("owner"), repository.alias("repo")
    ).select(F.sha2("span.value", 256).alias("hash"), "owner", "repo")
    by_repo = seen.groupBy("hash", "owner", "repo").agg(F.count(F.lit(1)).alias("n"))
    by_owner = by_repo.groupBy("hash", "owner").agg(F.sum("n").alias("n"), F.count(F.lit(1)).alias("n_pairs"))
    owners = by_owner.groupBy("hash").agg(F.sum("n").alias("n_spans"), F.count(F.lit(1)).alias("n_owners"))
    repos = by_repo.groupBy("hash", "repo").agg(F.count(F.lit(1)).alias("n_in"))
    repos = repos.groupBy("hash").agg(F.count(F.lit(1)).alias("n_repositories"))
    return owners.join(repos, "hash")


def _judged(docs: DataFrame, found: DataFrame, spread: float) -> DataFrame:
    """``row`` and, of its spans, those whose value is owner-specific (``live``) and the number of others.

    ``docs`` has the owner of every text, ``found`` the rows with spans.  A value dealt at random to r
    repositories of N owners has e = N (1 - (1 - 1/N) ** r) owners.  A value of n owners scores (n - 1) / N * n / e: how
    many of all owners copy it, times how scattered it is.  It is live up to ``spread``.
    """
    frequency = stored(ownership(found, F.col("owner"), F.col("repository")), "ownership")
    owners = docs.select("owner").distinct().agg(F.count(F.lit(1)).cast("double")).scalar()
    spans = found.select("row", F.explode(F.concat("base", "bare")).alias("span"))
    spans = spans.withColumn("hash", F.sha2("span.value", 256))
    expected = F.col("N") * (1 - F.pow(1 - 1 / F.col("N"), F.col("n_repositories")))
    score = (F.col("n_owners") - 1) / F.col("N") * F.col("n_owners") / expected
    judged = frequency.withColumn("N", owners).select("hash", (score <= spread).alias("live"))
    spans = spans.join(stored(judged, "verdicts"), "hash")
    return spans.groupBy("row").agg(
        F.array_sort(F.collect_list(F.when(F.col("live"), F.col("span")))).alias("live"),
        F.count_if(~F.col("live")).alias("n_copied"),
    )


def find_secrets(
    docs: DataFrame,
    owner: str = "source",
    repository: str = "doc_id",
    spread: float = 0.15,
) -> DataFrame:
    """One row per row of ``docs`` (doc_id, text and the two columns): its spans and their ownership.

    Columns: doc_id, ``base`` and ``live`` (arrays of spans; live: base or bare spans whose value is not
    copied by many of the owners, see ``_judged``; a value of one owner is live in however many repositories),
    ``n_copied`` (spans with a more widely copied value), and ``spans``: all base spans and the live bare ones.  Null, empty and
    span-free texts have empty arrays; texts of any length are read whole; repeated rows and ids each give
    a row; a null owner or repository counts as one of its own; an empty table gives no rows.  Further
    columns are ignored.
    """
    needed = docs.select("doc_id", "text", F.col(owner).alias("owner"), F.col(repository).alias("repository"))
    found = scan(needed).select(
        F.monotonically_increasing_id().alias("row"),
        F.col("doc.doc_id").alias("doc_id"),
        F.col("doc.owner").alias("owner"),
        F.col("doc.repository").alias("repository"),
        "base",
        "bare",
    )
    found = stored(found, "candidates")
    held = found.filter((F.size("base") > 0) | (F.size("bare") > 0))
    judged = _judged(found, held, spread)
    rows = found.join(judged, "row", "left")
    none = F.array().cast(SPAN_TYPE)
    rows = rows.withColumn("live", F.coalesce("live", none))
    added = F.filter("live", lambda s: s["rank"] >= len(BASE_KINDS))
    return rows.select(
        "doc_id",
        "base",
        "live",
        F.coalesce("n_copied", F.lit(0)).cast("long").alias("n_copied"),
        F.array_sort(F.concat("base", added)).alias("spans"),
    )


def redacted(text: Column, spans: Column, mark: str = "[secret]") -> Column:
    """``text`` with each run of overlapping spans replaced by ``mark``; spans come sorted by start."""

    def pieces(edge: Column) -> Column:
        # ``edge``: for each span the furthest end of those before it.  A run of spans reads its own stretch of the text.
        def stretch(run: Column) -> Column:
            first, last = run[0]["edge"], F.element_at(run, -1)["start"]
            own = F.substring(text, first + 1, F.greatest(last - first, F.lit(0)))

            def kept(own: Column) -> Column:
                return F.transform(
                    F.filter(run, lambda s: s["start"] >= s["edge"]),
                    lambda s: F.concat(F.substring(own, s["edge"] - first + 1, s["start"] - s["edge"]), F.lit(mark)),
                )

            return F.array_join(_let(own, kept), "")

        return F.array_join(F.transform(_blocks(edge), stretch), "")

    def edges(stops: Column) -> Column:
        before = lambda s, i: F.when(i > 0, F.get(stops, i - 1)).otherwise(F.lit(0))
        return F.transform(spans, lambda s, i: F.struct(s["start"].alias("start"), before(s, i).alias("edge")))

    stops = _running(F.transform(spans, lambda s: s["stop"]), lambda a, x: F.greatest(a, x))
    tail = F.substring(text, F.array_max(F.transform(spans, lambda s: s["stop"])) + 1, F.length(text))
    clean = _let(stops, lambda stops: _let(edges(stops), pieces))
    return F.when(F.size(spans) > 0, F.concat(clean, tail)).otherwise(text)


def redact_secrets(
    docs: DataFrame,
    owner: str = "source",
    repository: str = "doc_id",
    spread: float = 0.15,
) -> DataFrame:
    """``docs`` with every live span of ``text`` replaced; all rows and columns stay.

    Null and empty texts stay, and an empty table gives no rows.  ``n_chars``, where there is one, follows the new text.  Texts without spans are passed on
    without a shuffle; the others are joined to their own spans.
    """
    found = scan(docs).select(F.monotonically_increasing_id().alias("row"), "doc", "base", "bare")
    found = stored(found, "scanned")
    has = (F.size("base") > 0) | (F.size("bare") > 0)
    held = found.filter(has)
    owners = F.col(f"doc.`{owner}`").alias("owner")
    spans = held.select("row", "base", "bare", owners, F.col(f"doc.`{repository}`").alias("repository"))
    judged = _judged(found.select(owners), spans, spread).select("row", "live")
    clean = redacted(F.col("doc.text"), F.col("live"))
    joined = held.select("row", "doc").join(judged, "row")
    joined = joined.withColumn("clean", F.when(F.size("live") > 0, clean).otherwise(F.col("doc.text")))
    new = {"text": F.col("clean"), "n_chars": F.length("clean").cast("long")}
    columns = [
        (new[f.name].cast(f.dataType) if f.name in new else F.col(f"doc.`{f.name}`")).alias(f.name) for f in docs.schema
    ]
    passed = found.filter(~has).select([F.col(f"doc.`{f.name}`").alias(f.name) for f in docs.schema])
    return joined.select(columns).unionByName(passed)
