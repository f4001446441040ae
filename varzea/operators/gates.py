"""Gates, eligibility and stewards' decisions as ordered column expressions over records."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from varzea.functions.scalars import fold_key, reliability, route
from varzea.operators.rules import first_reason

# Statuses of closed places; moves that the board allows, by entity.
CLOSED = ["CLOSED_PERMANENTLY", "CLOSED_TEMPORARILY"]
DROPS = {
    "destino": ["rio>mar", "rio>descarte", "rio>dlq", "dlq>rio", "dlq>mar", "dlq>descarte"],
    "atrativo": ["rio>dlq", "dlq>rio", "rio>mar", "rio>descarte", "dlq>mar", "dlq>descarte"],
}
MAX_ATTEMPTS, MAX_EXPIRIES, SENDER = 3, 2, "Norteia"


def recent(at: Column, now: Column, days: int) -> Column:
    """Not older than `days`; null is not recent."""
    return F.coalesce(at >= now - F.make_interval(days=F.lit(days)), F.lit(False))


def send_gate(approved: list[str], cap: int) -> Column:
    """The first of nine conditions that a message fails, null if it may be sent. Reads phone, consented, body, opted_out,
    template, window_open (null counts as open), sub_state, sent_today (before this one) and quality_red."""
    c = F.col
    return first_reason(
        [
            ("contact_phone", F.coalesce(F.trim("phone"), F.lit("")) == ""),
            ("legal_basis", ~F.coalesce(c("consented"), F.lit(False))),
            ("sender", ~F.coalesce(c("body").contains(SENDER), F.lit(False))),
            ("opted_out", c("opted_out")),
            ("template", ~F.coalesce(c("template").isin(approved), F.lit(False))),
            ("window", ~F.coalesce(c("window_open"), F.lit(True))),
            ("sub_state", ~c("sub_state").eqNullSafe("whatsapp_in_progress")),
            ("ramp", c("sent_today") >= cap),
            ("quality", c("quality_red")),
        ]
    )


def batch_eligible(rows: DataFrame) -> DataFrame:
    """Attractions that a batch may describe."""
    return rows.filter((F.col("entity_type") == "attraction") & (F.col("routing") != "descarte") & F.col("batch_id").isNull() & F.col("name").isNotNull() & F.col("description").isNull() & (F.coalesce("attempts", F.lit(0)) < MAX_ATTEMPTS) & (F.coalesce("expiries", F.lit(0)) < MAX_EXPIRIES))


def has_hours_or_price(weekday: Column, owner_hours: Column, owner_price: Column) -> Column:
    return (F.coalesce(F.size(weekday), F.lit(0)) > 0) | owner_hours.isNotNull() | owner_price.isNotNull()


def outreach_reason() -> Column:
    """Why a requested record cannot go to outreach: reads found, entity_type, routing, in_whatsapp, has_hours."""
    return first_reason([("not_found", ~F.coalesce("found", F.lit(False))), ("not_attraction", F.col("entity_type") != "attraction"), ("not_in_dlq", F.col("routing") != "dlq"), ("already_in_whatsapp", F.col("in_whatsapp")), ("has_horario_or_preco", F.col("has_hours"))])


def outreach_branch(phone: Column) -> Column:
    """Records with a phone are written to, others go to discovery first."""
    return F.when(F.coalesce(phone, F.lit("")) != "", "outreach").otherwise("discovery")


def place_route(status: Column, newest: Column, now: Column, otherwise: Column) -> tuple[Column, Column]:
    """(routing, reason): closed places are discarded, places without a review of the last 90 days go to review."""
    closed, stale = F.coalesce(status.isin(CLOSED), F.lit(False)), ~recent(newest, now, 90)
    return F.when(closed, "descarte").when(stale, "dlq").otherwise(otherwise), F.when(closed, "closed_place").when(stale, "no_recent_reviews")


def seat_district(district: Column, municipality: Column) -> Column:
    """Null where the district is the seat, which bears the municipality's name."""
    return F.when(~F.coalesce(fold_key(district) == fold_key(municipality), F.lit(False)), district)


# Endings and words of files that are no photographs; the word of photographs whose grant has ended.
NO_PHOTO_ENDINGS = [".svg", ".tif", ".tiff", ".pdf", ".ogv", ".webm", ".xcf"]
NO_PHOTO_WORDS = ["flag of", "-logo", "commons-logo", "disambig", "icon", "coat of arms"]
RESTRICTED = "humanizada"


def any_of(conditions) -> Column:
    return F.coalesce(*(F.when(c, True) for c in conditions), F.lit(False))


def is_photo(title: Column, mime: Column) -> Column:
    t = F.lower(title)
    return any_of([mime.startswith("image/")]) & ~any_of([t.endswith(e) for e in NO_PHOTO_ENDINGS] + [t.contains(w) for w in NO_PHOTO_WORDS])


def license_verdict(license: Column, restrictions: Column) -> Column:
    """ok, rejected:<reason> or unknown: share-alike is accepted, no-derivatives and non-commercial are not."""
    x = F.lower(F.coalesce(license, F.lit("")))
    has = lambda *words: any_of(x.contains(w) for w in words)
    begins = lambda *words: any_of(x.startswith(w) for w in words)
    named = first_reason([("rejected:restrictions", F.coalesce(restrictions, F.lit("")) != ""), ("unknown", x == ""), ("rejected:nd", has("-nd", "noderiv")), ("rejected:nc", has("-nc", "noncommercial")), ("ok", begins("cc0", "pd", "cc-by") | has("public domain"))])
    return F.coalesce(named, F.lit("unknown"))


def is_restricted(*texts: Column) -> Column:
    return F.lower(F.concat_ws(" ", *texts)).contains(RESTRICTED)


def filter_cards(cards: DataFrame, kind: str | None = None, uf: str | None = None, text: str | None = None) -> DataFrame:
    """The board's filters; a null title matches no text."""
    out = cards
    if kind:
        out = out.filter(F.col("type") == kind)
    if uf:
        out = out.filter(F.col("uf") == uf)
    return out.filter(F.lower("title").contains(text.strip().lower())) if text and text.strip() else out


def gate_queue(rows: DataFrame, uf: str | None = None, limit: int = 100) -> DataFrame:
    """Attractions that wait for a person, by id (the limit is the feature)."""
    waiting = rows.filter("entity_type = 'attraction' AND sub_state = 'awaiting'")
    return (waiting.filter(F.col("uf") == uf) if uf else waiting).orderBy("id").limit(limit)


def gate_decision(sub_state: Column, decision: Column) -> tuple[Column, Column]:
    """(sub_state, conflict): approvals and rejections apply to waiting records only, any other is a conflict."""
    waiting = F.coalesce(sub_state == "awaiting", F.lit(False))
    after = F.when(waiting & (decision == "approve"), "approved").when(waiting & (decision == "reject"), "rejected").otherwise(sub_state)
    return after, decision.isNotNull() & ~waiting


def validated(rows: DataFrame, uf: str, limit: int = 1000) -> DataFrame:
    """A region's review queue, up to `limit` records by id, approved by a person: scored and routed anew."""
    score, _ = reliability()
    queue = rows.filter((F.col("routing") == "dlq") & (F.col("uf") == uf)).orderBy("id").limit(limit)
    return queue.withColumn("human", F.lit(100.0)).withColumn("score", score).withColumn("routing", route(F.col("score")))


def transition(rows: DataFrame, now: Column) -> DataFrame:
    """Add `outcome` of a move (column, expected, target): conflict if the record is elsewhere, held if an attraction without
    a review of the last 90 days would be promoted, refused if the board has no such move, else moved."""
    edges = F.array(*(F.lit(f"{k}:{e}") for k, es in DROPS.items() for e in es))
    move = F.concat(F.col("type"), F.lit(":"), F.col("expected"), F.lit(">"), F.col("target"))
    held = (F.col("type") == "atrativo") & (F.col("target") == "mar") & ~recent(F.col("newest_review"), now, 90)
    return rows.withColumn("outcome", F.coalesce(first_reason([("conflict", F.col("column") != F.col("expected")), ("refused", ~F.array_contains(edges, move)), ("held", held)]), F.lit("moved")))


def drop_action(kind: Column, column: Column, target: Column) -> Column:
    """`transition` where the board allows the drop of a card, null otherwise (its own column included)."""
    edges = F.array(*(F.lit(f"{k}:{e}") for k, es in DROPS.items() for e in es))
    return F.when((column != target) & F.array_contains(edges, F.concat(kind, F.lit(":"), column, F.lit(">"), target)), "transition")


def retry_action(kind: Column) -> Column:
    return F.when(kind == "destino", "reprocess")


def discard_guard(rows: DataFrame, canonical: DataFrame) -> DataFrame:
    """Add `conflict`: a record that the canonical layer has cannot be discarded."""
    there = canonical.select("source_ref").distinct().withColumn("conflict", F.lit(True))
    return rows.join(there, "source_ref", "left").withColumn("conflict", F.coalesce("conflict", F.lit(False)))
