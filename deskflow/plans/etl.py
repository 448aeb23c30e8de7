"""Cleaning and loading: raw sources -> typed, keyed warehouse rows.

Every step is a DataFrame transformation; a row that would fail a type
conversion or a key constraint is not dropped silently but routed to a
rejected frame with the reason (the first failing check, in column order).
Random values and "now" of the original loaders are replaced by a
deterministic integer mix of the row key and an injected ``as_of`` time.
"""

from __future__ import annotations

import datetime as _dt

from pyspark import StorageLevel
from pyspark.sql import Column, DataFrame, functions as F

from deskflow import schemas
from deskflow.functions import clean
from deskflow.functions.temporal import add_days, add_hours, add_minutes, calendar_parts, parse_dayfirst, parse_iso, round_to_millis
from deskflow.operators.joins import ROW, Constant, first_per_key, lookup_with_default, mark_repeats, split_by_foreign_keys, with_row_numbers
from deskflow.operators.keys import dense_ids

AS_OF = _dt.datetime(2024, 6, 30, 0, 0, 0)

# Salts of the deterministic stand-ins for random integers.
SALT_DAYS, SALT_RESPONSE, SALT_RESOLVE, SALT_CLOSE, SALT_INTERACT = 11, 23, 37, 41, 53


def as_of_lit(as_of: _dt.datetime = AS_OF) -> Column:
    """The run time as a wall-clock literal (text cast, so no time zone is involved)."""
    return F.lit(as_of.isoformat(sep=" ")).cast("timestamp_ntz")


def _shared(df: DataFrame, keep: list | None) -> DataFrame:
    """Persist an intermediate read by both outputs of a load (accepted and
    rejected rows are written by two jobs); the caller releases ``keep``."""
    if keep is None:
        return df
    df = df.persist(StorageLevel.MEMORY_AND_DISK)
    keep.append(df)
    return df


def _not_integer(name: str) -> tuple[Column, Column]:
    """Check that a column holds an integer; the reason keeps the value."""
    text = F.coalesce(F.col(name).cast("string"), F.lit("null"))
    return F.col(name).try_cast("long").isNotNull(), F.concat(F.lit(f"{name} is not an integer: "), text)


def _first_reason(checks: list[tuple[Column, str | Column]]) -> Column:
    """Reason of the first failing check (checks are 'is ok' conditions)."""
    out = F.lit(None).cast("string")
    for ok, reason in reversed(checks):
        out = F.when(~F.coalesce(ok, F.lit(False)), F.lit(reason)).otherwise(out)
    return out


# ------------------------------------------------------------------ tickets
def rename_ticket_columns(raw_ticket: DataFrame) -> DataFrame:
    return clean.rename_columns(raw_ticket, schemas.TICKET_RENAMES)


def ticket_priority_rules(raw_ticket: DataFrame) -> DataFrame:
    return raw_ticket.select("seq", "priority", clean.ticket_priority_id("priority").alias("priority_id"))


def synthetic_lifecycle(key: str, as_of: _dt.datetime = AS_OF) -> dict[str, Column]:
    """Deterministic ticket times chained from a row key: created some days
    before ``as_of``, first response minutes later, resolved hours later,
    closed minutes after that; plus an interaction count."""
    days = clean.synthetic_int(key, 1, 180, SALT_DAYS)
    resp = clean.synthetic_int(key, 5, 120, SALT_RESPONSE)
    hours = clean.synthetic_int(key, 1, 72, SALT_RESOLVE)
    close = clean.synthetic_int(key, 5, 60, SALT_CLOSE)
    created = add_days(as_of_lit(as_of), -days)
    first = add_minutes(created, resp)
    resolved = add_hours(first, hours)
    return {
        "days_ago": days, "response_minutes": resp, "resolve_hours": hours, "close_minutes": close,
        "agent_interactions": clean.synthetic_int(key, 1, 10, SALT_INTERACT),
        "created_at": created, "first_response_at": first, "resolved_at": resolved,
        "closed_at": add_minutes(resolved, close),
    }


def synthetic_fill(raw_ticket: DataFrame, as_of: _dt.datetime = AS_OF) -> DataFrame:
    cols = synthetic_lifecycle("seq", as_of)
    return raw_ticket.select("seq", *[c.alias(n) for n, c in cols.items()])


def surrogate_key(raw_ticket: DataFrame) -> DataFrame:
    """Dense ticket ids from 10000 in source order, and round-robin client,
    site and agent keys from the same position."""
    numbered = dense_ids(raw_ticket.select("seq"), ["seq"], "__n", base=0)
    n = F.col("__n")
    return numbered.select("seq", (F.lit(10000) + n).alias("ticket_id"), clean.round_robin(n, 5).alias("client_id"),
                           clean.round_robin(n, 6).alias("site_id"), clean.round_robin(n, 5).alias("agent_id"))


FIRST_TICKET_ID = 10000


def ticket_transform(raw_ticket: DataFrame, first_id: int = FIRST_TICKET_ID) -> DataFrame:
    """Priority text -> name (unmatched -> Medium), survey default, generated
    ticket id (from ``first_id``) when absent, and defaults for absent
    columns."""
    df = rename_ticket_columns(raw_ticket)
    df = df.withColumn("priority", clean.ticket_priority_name("priority"))
    if "survey_results" in df.columns:
        df = df.withColumn("survey_results", F.coalesce(F.col("survey_results"), F.lit("Neutral")))
    if "ticket_id" not in df.columns:
        df = dense_ids(df, ["seq"], "ticket_id", base=first_id)
    return clean.add_missing(df, schemas.TICKET_DEFAULTS)


def default_columns(raw_ticket: DataFrame) -> DataFrame:
    """A source without a subject column: defaults are added only for
    absent columns, the subject is built from the row position."""
    df = raw_ticket.drop("subject")
    df = clean.add_missing(df, schemas.TICKET_DEFAULTS)
    if "subject" not in df.columns:
        df = dense_ids(df, ["seq"], "__n", base=0)
        df = df.withColumn("subject", F.concat(F.lit("Ticket "), F.col("__n").cast("string"))).drop("__n")
    return df.select("seq", *schemas.TICKET_DEFAULTS, "subject")


def agent_lookup(raw_ticket: DataFrame, dim_agent: DataFrame) -> DataFrame:
    """Queue -> agent id (duplicate groups: the last agent wins); default 1."""
    out = lookup_with_default(raw_ticket.select("seq", "queue"), "queue", dim_agent, "assignment_group",
                              "agent_id", "agent_id", default=1, last_wins_by="agent_id")
    return out.select("seq", "queue", "agent_id")


def prepare_tickets(raw_ticket: DataFrame, dim_agent: DataFrame, dim_priority: DataFrame,
                    as_of: _dt.datetime = AS_OF, first_id: int = FIRST_TICKET_ID) -> DataFrame:
    """Raw tickets -> fact_ticket rows (before key checks)."""
    t = ticket_transform(raw_ticket, first_id)
    t = lookup_with_default(t, "queue", dim_agent, "assignment_group", "agent_id", "__agent", 1, "agent_id")
    t = lookup_with_default(t, "priority", dim_priority, "priority_name", "priority_id", "__prio", 3, "priority_id")
    life = synthetic_lifecycle("ticket_id", as_of)
    width = schemas.TICKET_TEXT_WIDTHS
    src = lambda name, default: F.col(name) if name in t.columns else F.lit(default)
    return t.select(
        F.col("ticket_id").cast("long"), F.col("client_id").cast("long"), F.col("site_id").cast("long"),
        F.col("__agent").cast("long").alias("agent_id"), F.col("__prio").cast("int").alias("priority_id"),
        life["created_at"].alias("created_at"), life["first_response_at"].alias("first_response_at"),
        life["resolved_at"].alias("resolved_at"), life["closed_at"].alias("closed_at"),
        F.col("status").alias("status"),
        clean.truncate(src("source", "Email"), width["source"]).alias("source"),
        clean.truncate(src("type", "General"), width["topic"]).alias("topic"),
        clean.truncate(src("subject", "No subject"), width["subject"]).alias("subject"),
        clean.truncate(src("body", ""), width["body"]).alias("body"),
        *[F.lit(v).alias(k) for k, v in schemas.TICKET_SLA_MINUTES.items()],
        life["agent_interactions"].alias("agent_interactions"),
        clean.truncate(src("survey_results", "Neutral"), width["survey_results"]).alias("survey_results"),
        clean.truncate(src("version", "Standard"), width["product_group"]).alias("product_group"),
        clean.truncate(src("tag_1", "Standard"), width["support_level"]).alias("support_level"),
    )


def ticket_key_checks(dims: dict[str, DataFrame], source_columns) -> list:
    """Key checks for tickets; keys the source lacks hold their default for
    every row and are checked once."""
    renamed = set(rename_ticket_columns_names(source_columns))
    key = lambda c: c if c in renamed else Constant(schemas.TICKET_DEFAULTS[c])
    return [(key("client_id"), dims["dim_client"], "client_id", "client_id not in dim_client"),
            (key("site_id"), dims["dim_site"], "site_id", "site_id not in dim_site"),
            ("agent_id", dims["dim_agent"], "agent_id", "agent_id not in dim_agent"),
            ("priority_id", dims["dim_priority"], "priority_id", "priority_id not in dim_priority")]


def rename_ticket_columns_names(columns) -> list[str]:
    return [schemas.TICKET_RENAMES.get(c, c) for c in columns]


def load_fact_ticket(raw_ticket: DataFrame, dims: dict[str, DataFrame], as_of: _dt.datetime = AS_OF,
                     keep: list | None = None, first_id: int = FIRST_TICKET_ID):
    """(accepted, rejected) ticket rows.  Rejected: a supplied key that is
    not an integer, a repeated ticket id (the first by ``seq`` stays), or a
    failed key check.  ``first_id`` is the first id given to a source
    without ticket ids."""
    raw_ticket, bad = split_supplied_keys(raw_ticket)
    rows = prepare_tickets(raw_ticket, dims["dim_agent"], dims["dim_priority"], as_of, first_id)
    accepted, rejected = split_by_foreign_keys(rows, ticket_key_checks(dims, raw_ticket.columns))
    if bad is not None:
        rejected = rejected.unionByName(bad, allowMissingColumns=True)
    if keep is None:
        return accepted, rejected
    both = _shared(accepted.withColumn("reject_reason", F.lit(None).cast("string")).unionByName(rejected), keep)
    return (both.where(F.col("reject_reason").isNull()).drop("reject_reason"),
            both.where(F.col("reject_reason").isNotNull()))


def split_supplied_keys(raw_ticket: DataFrame) -> tuple[DataFrame, DataFrame | None]:
    """(rows with sound keys, rejected ticket_id and reason or None): supplied
    keys become integers, and only the first row of a ticket id stays."""
    supplied = [c for c in ("ticket_id", "client_id", "site_id") if c in raw_ticket.columns]
    if not supplied:
        return raw_ticket, None
    # A null client or site is no key at all, but a null ticket id is.
    checks = [_not_integer(c) if c == "ticket_id" else (_not_integer(c)[0] | F.col(c).isNull(), _not_integer(c)[1])
              for c in supplied]
    marked = raw_ticket.withColumn("reject_reason", _first_reason(checks))
    marked = marked.withColumns({c: F.col(c).try_cast("long") for c in supplied})
    if "ticket_id" in supplied:
        # A row that is rejected anyway holds no id.
        sound = F.when(F.col("reject_reason").isNull(), F.col("ticket_id"))
        marked = mark_repeats(marked.withColumn("__id", sound), "__id", ["seq"])
        again = F.when(F.col("__again"), F.lit("ticket_id is repeated"))
        marked = marked.withColumn("reject_reason", F.coalesce("reject_reason", again)).drop("__id", "__again")
    number = F.col("ticket_id") if "ticket_id" in supplied else F.lit(None).cast("long")
    bad = marked.where(F.col("reject_reason").isNotNull()).select(number.alias("ticket_id"), "reject_reason")
    return marked.where(F.col("reject_reason").isNull()).drop("reject_reason"), bad


def fk_rejects(batch: DataFrame, dim_client: DataFrame, dim_site: DataFrame) -> DataFrame:
    """Batch rows whose client or site does not exist, with the reason."""
    _, rejected = split_by_foreign_keys(batch, [
        ("client_id", dim_client, "client_id", "client_id not in dim_client"),
        ("site_id", dim_site, "site_id", "site_id not in dim_site")])
    return rejected.select("ticket_id", "client_id", "site_id", "seq", "reject_reason")


def pk_dedupe(batch: DataFrame, target: DataFrame) -> DataFrame:
    """Rows a batch would add: first row per ticket id (by seq), minus ids
    the target already holds (a re-run adds nothing)."""
    first = first_per_key(batch, ["ticket_id"], ["seq"])
    return first.join(target.select("ticket_id").distinct(), "ticket_id", "left_anti").select(
        "ticket_id", "client_id", "site_id", "seq")


# ---------------------------------------------------------------- incidents
INCIDENT_TIMES = ("acknowledged_at", "resolved_at", "closed_at")
INCIDENT_COUNTS = ("reopen_count", "client_id", "site_id")


def incident_clean(raw_incident: DataFrame, keep: tuple[str, ...] = ()) -> DataFrame:
    """Placeholders to null, trimmed/lowered text, state codes, leading
    integers of impact/urgency, priority label, booleans as 0/1, day-first
    times.  Further times, counts and keys come along when the source has
    them; so do ``keep`` columns, as they are."""
    df = raw_incident
    out = df.select(
        F.col("number").alias("incident_id"),
        clean.clean_state("incident_state").alias("incident_state"),
        clean.bool_to_int("active").alias("active"),
        clean.bool_to_int("made_sla").alias("made_sla"),
        F.col("reassignment_count").try_cast("int").alias("reassignment_count"),
        F.col("sys_mod_count").alias("modification_count"),
        parse_dayfirst("opened_at").alias("opened_at"),
        clean.leading_int("impact").alias("impact"),
        clean.leading_int("urgency").alias("urgency"),
        F.col("priority"),
        clean.incident_priority_label("priority").alias("priority_name"),
        clean.placeholder_to_null("vendor", "?").alias("vendor"),
        F.trim("assignment_group").alias("assignment_group"),
        F.lower(F.trim("contact_type")).alias("contact_type"),
        *[parse_dayfirst(F.col(c).cast("string")).alias(c) for c in INCIDENT_TIMES if c in df.columns],
        *[F.col(c).try_cast("long").alias(c) for c in INCIDENT_COUNTS if c in df.columns],
        *keep,
    )
    return out


def incident_priority_rules(raw_incident: DataFrame) -> DataFrame:
    label = clean.incident_priority_label("priority")
    return raw_incident.select(F.col("number").alias("incident_id"), "priority", label.alias("priority_name"),
                               clean.incident_priority_id(F.col("priority"), label).alias("priority_id"))


def _incident_reason(raw_incident: DataFrame) -> Column:
    """The first failing conversion of a raw incident."""
    counts = ["reassignment_count", *[c for c in INCIDENT_COUNTS if c in raw_incident.columns]]
    checks = [_not_integer("number")]
    checks += [(_not_integer(c)[0] | F.col(c).isNull(), _not_integer(c)[1]) for c in counts]
    checks += [(clean.leading_int(c).isNotNull(), f"{c} is not an integer") for c in ("impact", "urgency")]
    return _first_reason(checks)


def _split_incidents(raw_incident: DataFrame) -> DataFrame:
    """Clean incidents with the reason a row is rejected for: a failed
    conversion, or an incident id that an accepted row before it (by ``seq``
    when the source has it, then by ``INCIDENT_ORDER``) has."""
    seq = ("seq",) if "seq" in raw_incident.columns else ()
    raw = with_row_numbers(raw_incident).withColumn("reject_reason", _incident_reason(raw_incident))
    raw = raw.withColumn("__id", F.when(F.col("reject_reason").isNull(), F.col("number").try_cast("long")))
    raw = mark_repeats(raw, "__id", [*seq, *INCIDENT_ORDER], prepare=lambda rows: incident_clean(rows, ("__id", ROW, *seq)))
    again = F.when(F.col("__again"), F.lit("incident_id is repeated"))
    return incident_clean(raw.withColumn("reject_reason", F.coalesce("reject_reason", again)), (*seq, "reject_reason"))


def incident_rejects(raw_incident: DataFrame) -> DataFrame:
    c = raw_incident.select(F.col("number").alias("incident_id"), _incident_reason(raw_incident).alias("reject_reason"))
    return c.where(F.col("reject_reason").isNotNull()).select(F.col("incident_id").try_cast("long").alias("incident_id"), "reject_reason")


INCIDENT_ORDER = ["opened_at", "incident_state", "impact", "urgency", "priority", "vendor",
                  "assignment_group", "made_sla", "active", "reassignment_count", "modification_count"]


def incident_impute(fact_incident: DataFrame) -> DataFrame:
    """Missing resolve time -> open time plus a deterministic 1-71 hours."""
    hours = clean.synthetic_int("incident_id", 1, 72, SALT_RESOLVE)
    return fact_incident.select(
        "incident_id", "opened_at",
        F.coalesce(F.col("resolved_at"), add_hours("opened_at", hours)).alias("resolved_at"),
        F.col("resolved_at").isNull().alias("resolved_imputed"))


def load_fact_incident(raw_incident: DataFrame, dims: dict[str, DataFrame], as_of: _dt.datetime = AS_OF,
                       keep: list | None = None):
    """(accepted, rejected) incident rows.  Rejected: a number that is not an
    integer, a repeated incident id (the first by ``seq``, when the source
    has it, stays), or a key check; every input row is in one of the two.
    Times, counts and keys of the source are taken as they are; only missing
    ones are imputed or defaulted."""
    c = _shared(_split_incidents(raw_incident), keep)
    given = set(c.columns)
    ok = c.where(F.col("reject_reason").isNull()).withColumn("incident_id", F.col("incident_id").try_cast("long"))
    rejected = c.where(F.col("reject_reason").isNotNull()).select(F.col("incident_id").try_cast("long").alias("incident_id"), "reject_reason")
    key = "incident_id"
    opened = F.coalesce(F.col("opened_at"), add_days(as_of_lit(as_of), -clean.synthetic_int(key, 1, 180, SALT_DAYS)))
    imputed = add_hours(opened, clean.synthetic_int(key, 1, 72, SALT_RESOLVE))
    w = schemas.INCIDENT_TEXT_WIDTHS

    def supplied(name: str, default: Column) -> Column:
        return F.coalesce(F.col(name), default) if name in given else default

    default_key = {c: F.lit(schemas.INCIDENT_DEFAULTS[c]).cast("long") for c in ("client_id", "site_id")}
    rows = ok.select(
        F.col("incident_id"), F.lit(None).cast("long").alias("ticket_id"),
        *[supplied(c, d).alias(c) for c, d in default_key.items()],
        clean.incident_priority_id(F.col("priority"), F.col("priority_name")).alias("priority_id"),
        opened.alias("opened_at"),
        *[F.col(c) for c in ("acknowledged_at", "closed_at") if c in given],
        supplied("resolved_at", imputed).alias("resolved_at"),
        clean.truncate("incident_state", w["incident_state"]).alias("incident_state"),
        "active", "reassignment_count", supplied("reopen_count", F.lit(0)).cast("int").alias("reopen_count"), "made_sla",
        clean.truncate("contact_type", w["contact_type"]).alias("contact_type"),
        "impact", "urgency",
        clean.truncate("assignment_group", w["assignment_group"]).alias("assignment_group"),
    )
    rows = _shared(rows, keep)
    # A key that the source lacks holds its default for every row: one test.
    tested = {c: c if c in given else Constant(schemas.INCIDENT_DEFAULTS[c]) for c in default_key}
    accepted, fk_rej = split_by_foreign_keys(rows, [
        (tested["client_id"], dims["dim_client"], "client_id", "client_id not in dim_client"),
        (tested["site_id"], dims["dim_site"], "site_id", "site_id not in dim_site"),
        ("priority_id", dims["dim_priority"], "priority_id", "priority_id not in dim_priority")])
    return accepted, rejected.unionByName(fk_rej.select("incident_id", "reject_reason"))


# ------------------------------------------------------------------ metrics
METRIC_COLUMNS = {"cpu_util_pct": "decimal(5,2)", "mem_util_pct": "decimal(5,2)", "link_util_pct": "decimal(5,2)",
                  "latency_ms": "decimal(8,2)", "packet_loss_pct": "decimal(5,2)"}


def metrics_clean(raw_metrics: DataFrame) -> DataFrame:
    """Drop the asset id, parse the time (bad -> null), numbers as doubles
    (non-numeric -> null)."""
    df = clean.drop_if_present(raw_metrics, "asset_id")
    return df.select("seq", *[c for c in (ROW,) if c in df.columns], F.col("site_id").try_cast("int").alias("site_id"),
                     parse_iso("timestamp_utc").alias("timestamp_utc"),
                     *[F.col(c).try_cast("double").alias(c) for c in METRIC_COLUMNS])


def _metrics_checks(site_ok: Column | None = None) -> list[tuple[Column, str]]:
    checks = [(F.col("site_id").isNotNull(), "site_id is missing"),
              (F.col("timestamp_utc").isNotNull(), "timestamp_utc is not a time")]
    for c, t in METRIC_COLUMNS.items():
        checks.append((F.col(c).isNotNull(), f"{c} is not a number"))
        checks.append((F.col(c).try_cast(t).isNotNull(), f"{c} does not fit {t}"))
    if site_ok is not None:
        checks.append((site_ok, "site_id not in dim_site"))
    return checks


def _metrics_with_reason(raw_metrics: DataFrame, dim_site: DataFrame) -> DataFrame:
    m = metrics_clean(raw_metrics)
    sites = dim_site.select(F.col("site_id").cast("int").alias("__site")).distinct().withColumn("__known", F.lit(True))
    m = m.join(sites, F.col("site_id") == F.col("__site"), "left")
    reason = _first_reason(_metrics_checks(F.col("__known").isNotNull()))
    return m.withColumn("reject_reason", reason).drop("__site", "__known")


METRIC_ORDER = ["timestamp_utc", "site_id"]


def split_metrics(raw_metrics: DataFrame, dim_site: DataFrame) -> DataFrame:
    """Clean metrics with the reason a row is rejected for: a failed check, no
    ``seq``, or a ``seq`` that an accepted row before it (by time, then site)
    has."""
    m = _metrics_with_reason(with_row_numbers(raw_metrics), dim_site)
    m = m.withColumn("reject_reason", F.coalesce("reject_reason", F.when(F.col("seq").isNull(), F.lit("seq is missing"))))
    m = mark_repeats(m.withColumn("__seq", F.when(F.col("reject_reason").isNull(), F.col("seq"))), "__seq", METRIC_ORDER)
    again = F.when(F.col("__again"), F.lit("seq is repeated"))
    return m.withColumn("reject_reason", F.coalesce("reject_reason", again)).drop("__seq", "__again")


def metrics_rejects(raw_metrics: DataFrame, dim_site: DataFrame, reasoned: DataFrame | None = None) -> DataFrame:
    m = reasoned if reasoned is not None else split_metrics(raw_metrics, dim_site)
    return m.where(F.col("reject_reason").isNotNull()).select("seq", "reject_reason")


def accepted_metrics(raw_metrics: DataFrame, dim_site: DataFrame, reasoned: DataFrame | None = None) -> DataFrame:
    """Accepted metric rows keyed by ``seq`` (typed, times rounded to ms)."""
    m = reasoned if reasoned is not None else split_metrics(raw_metrics, dim_site)
    m = m.where(F.col("reject_reason").isNull())
    return m.select("seq", "site_id", round_to_millis("timestamp_utc").alias("timestamp_utc"),
                    *[F.col(c).cast(t).alias(c) for c, t in METRIC_COLUMNS.items()])


def load_fact_metrics(raw_metrics: DataFrame, dim_site: DataFrame, keep: list | None = None):
    """(accepted, rejected): accepted rows get a dense metric id in source
    order; a missing or repeated ``seq`` is a reject."""
    reasoned = _shared(split_metrics(raw_metrics, dim_site), keep)
    acc = dense_ids(accepted_metrics(raw_metrics, dim_site, reasoned), ["seq"], "metric_id", base=1)
    acc = acc.select("metric_id", "site_id", "timestamp_utc", *METRIC_COLUMNS)
    return acc, metrics_rejects(raw_metrics, dim_site, reasoned)


# ------------------------------------------------------------------ staging
def stage_support(raw_support: DataFrame, as_of: _dt.datetime = AS_OF) -> DataFrame:
    """Support texts to staging: dense id, widths enforced, load time; the
    full text length is kept alongside."""
    w = schemas.SUPPORT_TEXT_WIDTHS
    df = dense_ids(raw_support.select(F.col("support_id").alias("source_id"), "body", "assignment_group",
                                      "priority_name", "support_level"), ["source_id"], "support_id", base=1)
    return df.select(
        "support_id", "source_id",
        *[clean.truncate(c, n).alias(c) for c, n in w.items()],
        as_of_lit(as_of).alias("load_date"),
        F.length("body").cast("long").alias("body_chars"))


# ----------------------------------------------------------------- lifecycle
def lifecycle_times(fact_ticket: DataFrame) -> DataFrame:
    """Estimated times where missing: +30 min response, +2 h resolve after
    create, +15 min close after resolve."""
    o = schemas.LIFECYCLE_OFFSETS_MIN
    resolved = F.coalesce(F.col("resolved_at"), add_minutes("created_at", o["resolved_after_create"]))
    return fact_ticket.select(
        "ticket_id", "created_at",
        F.coalesce(F.col("first_response_at"), add_minutes("created_at", o["first_response_after_create"])).alias("est_first_response_at"),
        resolved.alias("est_resolved_at"),
        F.coalesce(F.col("closed_at"), add_minutes(resolved, o["closed_after_resolve"])).alias("est_closed_at"))


def dim_time(*date_columns: Column, frames: list[DataFrame]) -> DataFrame:
    """Date dimension over the span of the given frames' dates: one row per
    day, id = days since the first date + 1."""
    bounds = None
    for frame, c in zip(frames, date_columns):
        b = frame.agg(F.min(F.to_date(c)).alias("lo"), F.max(F.to_date(c)).alias("hi"))
        bounds = b if bounds is None else bounds.unionByName(b)
    span = bounds.agg(F.min("lo").alias("lo"), F.max("hi").alias("hi"))
    days = span.select("lo", F.explode(F.sequence("lo", "hi")).alias("date"))
    parts = calendar_parts(F.col("date"))
    return days.select((F.datediff("date", "lo") + 1).alias("time_id"), "date",
                       F.dayofmonth("date").alias("day"), parts["month"].alias("month"),
                       parts["quarter"].alias("quarter"), parts["year"].alias("year"))
