"""What model providers' messages mean, as column expressions."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from quirekit.functions.text import strip

# Statuses and phrases of exhausted accounts and of passing trouble.
EXHAUSTED_STATUS = (402, 403)
TRANSIENT_STATUS = (408, 429, 500, 502, 503, 504)
EXHAUSTED_WORDS = ("quota", "insufficient", "billing", "credit", "balance", "exceeded your current quota", "payment required", "permission denied")
TRANSIENT_WORDS = (
    "service temporarily unavailable", "rate limit", "rate_limit", "too many requests", "overloaded", "capacity", "resource exhausted", "resource_exhausted",
    "temporarily unavailable", "model is overloaded", "server error", "upstream", "timeout", "timed out",
)
DELAY_KEYS = ("retryDelay", "quotaResetDelay")
RESET_KEY = "quotaResetTimeStamp"


def is_passing(status: int | None, message: str) -> bool:
    """Whether trouble with a provider is of a kind that waiting or another account may end."""
    known = status in EXHAUSTED_STATUS + TRANSIENT_STATUS
    return known or any(w in message.lower() for w in EXHAUSTED_WORDS + TRANSIENT_WORDS)


def any_word(text: Column, words: tuple[str, ...]) -> Column:
    """Whether the lower-cased text holds one of the words."""
    return F.lower(text).rlike("|".join(words))


def error_class(status: Column, message: Column) -> Column:
    """``exhaust``, ``transient`` or null; a status, given or found in the message, decides before words do."""
    text = F.coalesce(message, F.lit(""))
    code = F.coalesce(status, F.regexp_extract(text, r"\b([45]\d\d)\b", 1).try_cast("int"))
    return (
        F.when(code.isin(*EXHAUSTED_STATUS), "exhaust")
        .when(code.isin(*TRANSIENT_STATUS), "transient")
        .when(any_word(text, EXHAUSTED_WORDS), "exhaust")
        .when(any_word(text, TRANSIENT_WORDS), "transient")
    )


def duration_seconds(text: Column) -> Column:
    """Whole seconds, rounded up and at least one, of h/m/s amounts or of a bare number; else null."""
    s = F.lower(F.trim(text))
    amount = lambda u: F.aggregate(F.regexp_extract_all(s, F.lit(r"(\d+(?:\.\d+)?)" + u), F.lit(1)), F.lit(0.0), lambda t, x: t + x.cast("double"))
    total = amount("h") * 3600 + amount("m") * 60 + amount("s")
    bare = F.when(s.rlike(r"^\d+(\.\d+)?$"), s.try_cast("double"))
    seconds = F.when(s.rlike(r"\d[hms]"), total).otherwise(bare)
    return F.when(seconds.isNotNull(), F.greatest(F.ceil(seconds), F.lit(1))).cast("int")


def json_value(message: Column, key: str) -> Column:
    """Text of a key in JSON within a message, also where the JSON is quoted once more; null if there is none."""
    q = r'\\?"'
    return F.nullif(F.regexp_extract(message, f"(?i){q}{key}{q}" + rf"\s*:\s*{q}([^\"\\]+){q}", 1), F.lit(""))


def retry_delay(message: Column, now: Column | None = None) -> Column:
    """Seconds to wait that a message names, or null; with ``now`` also from the time at which it says a quota is reset."""
    found = [json_value(message, k) for k in DELAY_KEYS]
    after = F.nullif(F.regexp_extract(message, r"(?i)reset after\s+([0-9hms.]+)", 1), F.lit(""))
    delays = [F.when(x.isNotNull(), duration_seconds(x)) for x in [*found, after]]
    if now is not None:
        micros = F.unix_micros(F.try_to_timestamp(json_value(message, RESET_KEY))) - F.unix_micros(now)
        delays.append(F.when(micros > 0, F.ceil(micros / 1e6)).cast("int"))
    return F.coalesce(*delays)


def backoff_seconds(attempt: Column, provider_trouble: Column) -> Column:
    """Seconds before the next attempt: powers of two, up to 12 after a provider's trouble and 8 otherwise."""
    return F.least(F.pow(F.lit(2.0), attempt), F.when(provider_trouble, 12.0).otherwise(8.0)).cast("int")


def parse_response(response: Column) -> Column:
    """Text and finish reason of a chat response in JSON, as struct(text, finish_reason); parts of a text are joined by lines.

    What isn't such a response has an empty text and reason."""
    choice = "struct<finish_reason:string,finishReason:string,message:struct<content:string>>"
    first = F.get(F.from_json(response, f"struct<choices:array<{choice}>>")["choices"], F.lit(0))
    content = first["message"]["content"]
    parts = F.from_json(content, "array<struct<text:string>>")
    joined = F.array_join(F.filter(F.transform(parts, lambda p: p["text"]), lambda x: F.coalesce(x, F.lit("")) != ""), "\n")
    text = F.when(content.startswith("[") & parts.isNotNull(), joined).otherwise(content)
    reason = F.coalesce(F.nullif(first["finish_reason"], F.lit("")), first["finishReason"], F.lit(""))
    return F.struct(strip(F.coalesce(text, F.lit(""))).alias("text"), reason.alias("finish_reason"))


def reason_in(message: Column) -> Column:
    """Finish reason that an error text names, normalised; empty if it names none."""
    found = [F.nullif(F.regexp_extract(message, p, 1), F.lit("")) for p in (r'(?i)"finishReason"\s*:\s*"([^"]+)"', r"(?i)'finishReason'\s*:\s*'([^']+)'", r"(?i)finishReason\s*=\s*([A-Za-z0-9_.]+)")]
    return finish_reason(F.coalesce(*found, F.lit("")))


def finish_reason(reason: Column) -> Column:
    """Upper case, the part after the last dot; empty if null."""
    return F.substring_index(F.upper(F.trim(F.coalesce(reason, F.lit("")))), ".", -1)


def is_truncated(reason: Column) -> Column:
    """Whether a finish reason tells of a length limit."""
    return F.upper(F.coalesce(reason, F.lit(""))).rlike("LENGTH|MAX_TOKEN|MAX_OUTPUT")


def mime_type(name: Column) -> Column:
    """Media type by extension; JPEG if it is unknown."""
    ext = F.lower(F.regexp_extract(name, r"\.([^.]+)$", 1))
    return F.when(ext == "png", "image/png").when(ext == "webp", "image/webp").when(ext == "bmp", "image/bmp").when(ext.isin("tif", "tiff"), "image/tiff").otherwise("image/jpeg")
