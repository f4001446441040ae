"""Column functions: text normalisation, phones, geography, scoring steps and time."""

from __future__ import annotations

import unicodedata
from dataclasses import dataclass

from pyspark.sql import Column
from pyspark.sql import functions as F

def _plain_letters() -> tuple[str, str]:
    """Letters that are one letter and combining marks, and that letter: Latin, Greek and Cyrillic blocks and their extensions."""
    marked, plain = [], []
    for code in (*range(0xC0, 0x530), *range(0x1E00, 0x2000)):
        left = "".join(c for c in unicodedata.normalize("NFKD", chr(code)) if unicodedata.category(c) != "Mn")
        if len(left) == 1 and left != chr(code):
            marked.append(chr(code))
            plain.append(left)
    return "".join(marked), "".join(plain)


MARKED, PLAIN = _plain_letters()
# States of Brazil and their codes.
STATES = {
    "acre": "AC", "alagoas": "AL", "amapa": "AP", "amazonas": "AM", "bahia": "BA", "ceara": "CE", "distrito federal": "DF", "federal district": "DF", "espirito santo": "ES", "goias": "GO",
    "maranhao": "MA", "mato grosso": "MT", "mato grosso do sul": "MS", "minas gerais": "MG", "para": "PA", "paraiba": "PB", "parana": "PR", "pernambuco": "PE", "piaui": "PI", "rio de janeiro": "RJ",
    "rio grande do norte": "RN", "rio grande do sul": "RS", "rondonia": "RO", "roraima": "RR", "santa catarina": "SC", "sao paulo": "SP", "sergipe": "SE", "tocantins": "TO",
}
EARTH_KM = 6371.0


def round2(x: Column) -> Column:
    """Two decimals, half up on the scaled double: the same arithmetic in every engine."""
    return F.floor(x * 100 + 0.5) / 100


def fold(x: Column) -> Column:
    """Letters without marks: those composed with a mark by their base letter, combining marks dropped."""
    return F.regexp_replace(F.translate(x, MARKED, PLAIN), r"\p{Mn}+", "")


def collapse(x: Column) -> Column:
    return F.trim(F.regexp_replace(x, r"(?U)\s+", " "))


def title(x: Column) -> Column:
    """Upper case after anything that is no letter, lower case after a letter: unlike initcap, `d'ajuda` becomes `D'Ajuda`."""
    parts = F.regexp_extract_all(x, F.lit(r"\p{L}+|\P{L}+"), F.lit(0))
    return F.array_join(F.transform(parts, lambda p: F.concat(F.upper(F.substring(p, 1, 1)), F.lower(F.substr(p, F.lit(2))))), "")


def normalize_name(x: Column) -> Column:
    return title(collapse(x))


def normalize_address(x: Column) -> Column:
    return F.nullif(title(F.regexp_replace(x, r"(?U)^\s+|\s+$", "")), F.lit(""))


def fold_key(x: Column) -> Column:
    """Lower case, no marks, blanks collapsed: the key of exact name joins."""
    return collapse(F.lower(fold(x)))


def slug(x: Column) -> Column:
    s = F.regexp_replace(F.lower(fold(x)), "[^a-z0-9]+", "-")
    return F.coalesce(F.nullif(F.regexp_replace(s, "^-+|-+$", ""), F.lit("")), F.lit("sem-nome"))


def squeeze_alnum(x: Column) -> Column:
    return F.trim(F.regexp_replace(F.lower(fold(x)), "[^a-z0-9]+", " "))


def strip_apostrophes(x: Column) -> Column:
    return F.translate(x, "'’", "")


def state_to_uf(x: Column) -> Column:
    key = F.regexp_replace(fold_key(x), "^state of ", "")
    table = F.create_map(*(F.lit(y) for kv in STATES.items() for y in kv))
    return F.try_element_at(table, key)


def mask_phone(x: Column) -> Column:
    return F.when(F.length(x) <= 6, "***").otherwise(F.concat(F.substring(x, 1, 5), F.lit("*****"), F.substring(x, -2, 2)))


def whatsapp_candidate(x: Column) -> Column:
    """Masked +55 number of a Brazilian mobile phone, else null."""
    digits = F.regexp_replace(x, r"\D", "")
    foreign = x.startswith("+") & ~digits.startswith("55")
    national = F.when(digits.rlike(r"^55\d{11}$"), F.substring(digits, 3, 11)).when(digits.rlike(r"^\d{11}$"), digits)
    mobile = national.rlike(r"^[1-9]\d9\d{8}$")
    return F.when(~foreign & mobile, mask_phone(F.concat(F.lit("+55"), national)))


def split_phone(x: Column) -> Column:
    """struct(mobile, landline), one of them at most: a Brazilian mobile number, or any other as +55 and its digits. A number of
    another country and one of no known length stay as they are under landline; a text without digits gives neither."""
    digits = F.regexp_replace(x, r"\D", "")
    national = F.when(digits.rlike(r"^55\d{10,11}$"), F.substring(digits, 3, 11)).when(digits.rlike(r"^\d{10,11}$"), digits)
    full = F.when(~(F.trim(x).startswith("+") & ~digits.startswith("55")), F.concat(F.lit("+55"), national))
    mobile = full.rlike(r"^\+55\d{2}9\d{8}$")
    return F.struct(F.when(mobile, full).alias("mobile"), F.when(mobile, F.lit(None)).when(digits != "", F.coalesce(full, x)).alias("landline"))


def phone_e164(x: Column) -> Column:
    """A number with its + as it is without blanks and signs; else +55 before a national or a Brazilian one; others are null."""
    signs = F.regexp_replace(x, r"[^\d+]", "")
    return F.when(signs.rlike(r"^\+.*\d"), signs).when(signs.rlike(r"^\d{10,11}$"), F.concat(F.lit("+55"), signs)).when(signs.rlike(r"^55\d{10,11}$"), F.concat(F.lit("+"), signs))


def instagram_handle(x: Column) -> Column:
    """@name of a link whose host is instagram.com, else null."""
    name = F.regexp_extract(x, r"(?:^|/)(?:www\.)?instagram\.com/([^/?]+)", 1)
    return F.when(name.startswith("@"), name).when(name != "", F.concat(F.lit("@"), name))


# Fixed value: a phone number in a text is a digit, seven or more digits, blanks, brackets, dots and hyphens, and a digit.
_PHONE = r"(?U)\+?\d[\d\s().-]{7,}\d"


def scrub(x: Column, limit: int = 500) -> Column:
    """Phone numbers replaced, length bounded."""
    return F.substring(F.regexp_replace(x, _PHONE, "[redacted]"), 1, limit)


def redact(x: Column) -> Column:
    return F.when(F.length(x) > 0, "***").otherwise("")


def tourism_category(x: Column) -> Column:
    """Old letters and new phrases to three labels; the order of the tests matters."""
    u = F.upper(F.trim(x))
    return F.when(u.isin("A", "B") | u.contains("TURISTICO") | u.contains("TURÍSTICO"), "Turistico").when(u.isin("C", "D") | u.contains("COMPLEMENTAR"), "Complementar").otherwise("Apoio")


def source_of_key(x: Column) -> Column:
    return F.when(x.contains(":"), F.split_part(x, F.lit(":"), F.lit(1)))


def sentence_slug(x: Column) -> Column:
    s = F.regexp_replace(x, "[_-]+", " ")
    return F.concat(F.upper(F.substring(s, 1, 1)), F.substr(s, F.lit(2)))


def ellipsis(x: Column, limit: int = 160) -> Column:
    return F.when(F.length(x) > limit, F.concat(F.substring(x, 1, limit - 1), F.lit("…"))).otherwise(x)


def opt_out_tokens(x: Column, filler: list[str], words: list[str]) -> Column:
    """True if one word alone is left without fillers and it is an opt-out word; NAO counts as NÃO."""
    tokens = F.regexp_extract_all(F.upper(x), F.lit("([0-9A-ZÀ-ÖØ-Þ]+)"), F.lit(1))
    left = F.filter(F.transform(tokens, lambda t: F.when(t == "NAO", "NÃO").otherwise(t)), lambda t: ~t.isin(filler))
    return F.coalesce((F.size(left) == 1) & F.get(left, F.lit(0)).isin(words), F.lit(False))


def haversine_km(lat1: Column, lng1: Column, lat2: Column, lng2: Column) -> Column:
    dlat, dlng = F.radians(lat2 - lat1), F.radians(lng2 - lng1)
    a = F.pow(F.sin(dlat / 2), 2) + F.cos(F.radians(lat1)) * F.cos(F.radians(lat2)) * F.pow(F.sin(dlng / 2), 2)
    return F.lit(2 * EARTH_KM) * F.atan2(F.sqrt(a), F.sqrt(1 - a))


def token_jaccard(a: Column, b: Column) -> Column:
    """Share of common distinct tokens, four decimals."""
    x, y = F.array_distinct(F.split(F.lower(F.trim(a)), r"\s+")), F.array_distinct(F.split(F.lower(F.trim(b)), r"\s+"))
    return F.floor(F.try_divide(F.size(F.array_intersect(x, y)).cast("double"), F.size(F.array_union(x, y))) * 10000 + 0.5) / 10000


def dot(a: Column, b: Column) -> Column:
    return F.aggregate(F.zip_with(a, b, lambda x, y: x.cast("double") * y.cast("double")), F.lit(0.0), lambda s, x: s + x)


def cosine(a: Column, b: Column) -> Column:
    """0 if either vector has norm 0."""
    n = F.sqrt(dot(a, a)) * F.sqrt(dot(b, b))
    return F.when(n == 0, F.lit(0.0)).otherwise(dot(a, b) / n)


@dataclass(frozen=True)
class ScoreConfig:
    """Weights (percent) of the five criteria and the threshold of the canonical layer."""

    origin: float = 30.0
    completeness: float = 20.0
    corroboration: float = 20.0
    recency: float = 15.0
    human: float = 15.0
    threshold: float = 80.0
    version: str = "v1.0"

    def weights(self) -> dict[str, float]:
        return {"origin": self.origin, "completeness": self.completeness, "corroboration": self.corroboration, "recency": self.recency, "human": self.human}


def reliability(config: ScoreConfig = ScoreConfig()) -> tuple[Column, Column]:
    """(score, breakdown) of the columns origin, completeness, corroboration, recency, human; points add up from left to right."""
    points = {k: F.coalesce(F.col(k), F.lit(0.0)) * w / 100.0 for k, w in config.weights().items()}
    total = None
    for p in points.values():
        total = p if total is None else total + p
    return round2(total), F.struct(*(p.alias(k) for k, p in points.items()))


def route(score: Column, config: ScoreConfig = ScoreConfig()) -> Column:
    return F.when(score >= config.threshold, "mar").otherwise("dlq")


def corroboration_from_reviews(n: Column) -> Column:
    """Of a review count; none, or null, gives 0."""
    return F.when(n.isNull() | (n <= 0), 0.0).otherwise(round2(F.least(F.lit(100.0), F.lit(100.0) * F.log1p(n.cast("double")) / F.log1p(F.lit(500.0)))))


def recency_steps(age_days: Column) -> Column:
    """Whole days since the newest review; null gives 0, the future 100."""
    return F.when(age_days.isNull(), 0.0).when(age_days <= 30, 100.0).when(age_days <= 180, 70.0).when(age_days <= 365, 40.0).when(age_days <= 730, 20.0).otherwise(0.0)


def recency_of_reviews(ages: Column) -> Column:
    """Array of exact ages in days: any up to 30 gives 100, any up to 180 gives 50."""
    least = F.array_min(ages)
    return F.when(least <= 30, 100.0).when(least <= 180, 50.0).otherwise(0.0)


def completeness(fields: list[Column], cap: float = 100.0) -> Column:
    """Share of present fields; 0 is present, the empty string and empty arrays and maps are not."""
    present = sum((F.when(f.isNotNull() & ~f.cast("string").isin("", "[]", "{}"), 1).otherwise(0) for f in fields), F.lit(0))
    return round2(present / float(len(fields)) * cap)


def completeness_steps(present: Column) -> Column:
    return F.when(present >= 3, 90.0).when(present == 2, 75.0).when(present == 1, 50.0).otherwise(25.0)


# Fields that no log keeps.
BLOCKED = "cookie cookies session token proxy user_agent password secret authorization api_key exc_info".split()


def sanitize(fields: Column, limit: int = 2000) -> Column:
    """A log's map without blocked fields (in any case), long values cut."""
    return F.transform_values(F.map_filter(fields, lambda k, v: ~F.lower(k).isin(BLOCKED)), lambda k, v: F.substring(v, 1, limit))


def strip_dashes(x: Column) -> Column:
    """A dash between blanks becomes a comma, any other a blank; runs of blanks fall together."""
    return F.trim(F.regexp_replace(F.translate(F.regexp_replace(x, " [—–] ", ", "), "—–", "  "), " {2,}", " "))


def uf_hint(categories: Column, name: Column) -> Column:
    """The state that a category names in its first brackets (the first category that does), else the only state code that stands
    alone in the title, where letters A-Z on either side would make it part of a word."""
    table = F.create_map(*(F.lit(y) for kv in STATES.items() for y in kv))
    bracketed = lambda c: F.when(c.contains("(") & F.split_part(c, F.lit("("), F.lit(2)).contains(")"), F.split_part(F.split_part(c, F.lit("("), F.lit(2)), F.lit(")"), F.lit(1)))
    named = F.filter(F.transform(categories, lambda c: F.try_element_at(table, fold_key(bracketed(c)))), lambda u: u.isNotNull())
    words = F.array_distinct(F.split(F.coalesce(name, F.lit("")), "[^A-Za-z]+"))
    codes = F.array_intersect(words, F.array(*(F.lit(u) for u in sorted(set(STATES.values())))))
    return F.coalesce(F.get(named, F.lit(0)), F.when(F.size(codes) == 1, F.get(codes, F.lit(0))))


def coordinate(x: Column) -> Column:
    """Six decimals."""
    return F.round(x, 6)


def moment(x: Column) -> Column:
    """An ISO 8601 text as an instant, UTC where it names no zone; null where it cannot be read."""
    return F.try_to_timestamp(F.when(x.rlike(r"^\d{4}-\d{2}-\d{2}[T ].*\d$") & ~x.rlike(r"[+-]\d{2}:?\d{2}$"), F.concat(x, F.lit("Z"))).when(x.rlike(r"^\d{4}-\d{2}-\d{2}$"), F.concat(x, F.lit("T00:00:00Z"))).otherwise(x))


def price_level(x: Column) -> Column:
    names = ["FREE", "INEXPENSIVE", "MODERATE", "EXPENSIVE", "VERY_EXPENSIVE"]
    return F.try_element_at(F.create_map(*(y for i, n in enumerate(names) for y in (F.lit(f"PRICE_LEVEL_{n}"), F.lit(i)))), x)


def llm_cost(tokens_in: Column, tokens_out: Column, cache_write: Column, cache_read: Column, searches: Column, batch: Column) -> Column:
    tokens = tokens_in * 3.0 + cache_write * 3.0 * 1.25 + cache_read * 3.0 * 0.1 + tokens_out * 15.0
    return tokens * F.when(batch, 0.5).otherwise(1.0) / 1e6 + searches * 0.01


def batch_size(limit: int, remaining_usd: Column, reserve: float = 0.075) -> Column:
    """How many calls the remaining budget pays for, `limit` at most; none where the budget is unknown or used up."""
    return F.when(remaining_usd > 0, F.least(F.lit(limit), F.floor(remaining_usd / reserve))).otherwise(0).cast("int")


def seconds_to_midnight(ts: Column) -> Column:
    return F.lit(86400) - (F.hour(ts) * 3600 + F.minute(ts) * 60 + F.second(ts))
