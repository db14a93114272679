"""Model calls as injected providers: retries, resume by hash, results and dead letters in one table."""

from __future__ import annotations

import hashlib
from collections.abc import Callable, Iterator
from dataclasses import dataclass

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from quirekit.functions.markup import last_header, page_errors
from quirekit.functions.providers import is_passing
from quirekit.operators import pages as pg
from quirekit.operators.pages import fold_pages
from quirekit.operators.reconcile import unprocessed


REFUSED = "__PROHIBITED_CONTENT__"
REFUSING_REASONS = ("CONTENT_FILTER", "PROHIBITED_CONTENT")
LIMIT_REASONS = ("LENGTH", "MAX_TOKEN", "MAX_OUTPUT")


@dataclass(frozen=True)
class Answer:
    """What a provider gives for one request."""

    text: str
    finish_reason: str = "STOP"


class ProviderError(Exception):
    """A provider's trouble, with the status that it gave if any."""

    def __init__(self, message: str, status: int | None = None) -> None:
        super().__init__(message)
        self.status = status


#: A request text to an answer; raises on trouble.
Provider = Callable[[str], Answer]


@dataclass(frozen=True)
class Outcome:
    """A call's status (ok, prohibited, failed), text, error, attempts, finish reason and the last output that was rejected."""

    status: str
    text: str | None
    error: str | None
    attempts: int
    finish_reason: str | None
    rejected: str | None


def token_limited(send: Callable[..., Answer], limit: int, names: tuple[str, ...] = ("max_tokens", "max_completion_tokens")) -> Provider:
    """A provider that gives a limit under the first of ``names`` that the service takes, and none if it takes none."""

    def ask(request: str) -> Answer:
        for i, name in enumerate(names):
            try:
                return send(request, **{name: limit})
            except Exception as e:
                if i == 0 and not any(n in str(e).lower() for n in names):
                    raise
        return send(request)

    return ask


def call(provider: Provider, request: str, attempts: int, check: Callable[[str], list[str]], clean: Callable[[str], str] = str, wait: Callable[[float], object] | None = None) -> Outcome:
    """The outcome of a request. Refusals aren't tried again.

    ``clean`` makes the text that is kept (ValueError: the output is rejected), ``check`` lists what is wrong with it. Between attempts
    ``wait`` (``time.sleep`` where a service needs it) gets the seconds: powers of two, up to 12 after passing trouble and 8 after any other.
    """
    error = reason = rejected = None
    for n in range(1, attempts + 1):
        most = 8
        try:
            got = provider(request)
            reason = got.finish_reason
            if got.text.strip() == REFUSED or any(x in reason.upper() for x in REFUSING_REASONS):
                return Outcome("prohibited", None, "provider refused", n, reason, None)
            if any(x in reason.upper() for x in LIMIT_REASONS):
                error = f"cut off: {reason}"
            elif problems := check(text := clean(got.text)):
                error = "; ".join(problems)
            else:
                return Outcome("ok", text, None, n, reason, None)
            rejected = got.text
        except Exception as e:  # any provider's trouble becomes a row
            error = f"{type(e).__name__}: {e}"
            most = 12 if is_passing(getattr(e, "status", None), str(e)) else 8
        if wait and n < attempts:
            wait(min(2**n, most))
    return Outcome("failed", None, error, attempts, reason, rejected)


OUTCOME = {"status": pa.string(), "text": pa.string(), "error": pa.string(), "attempts": pa.int32(), "finish_reason": pa.string(), "rejected": pa.string()}


def recognise(pages: DataFrame, key: list[str], request: str, provider: Provider, *, attempts: int = 3, check: Callable[[str], list[str]] = page_errors, clean: Callable[[str], str] = str, wait: Callable[[float], object] | None = None, prompt: str | None = None, model: str | None = None, profile: str | None = None) -> DataFrame:
    """Each page's answer with its record, one row a page: see ``Outcome``, input_sha256, output_sha256, prompt_sha256, model, profile.

    Text and sidecar are one row, so no crash can part them; rows of other status than ok are the dead letters."""
    rows = pages.select(*key, F.col(request).alias("_request"))
    n = len(key)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            got = [call(provider, r or "", attempts, check, clean, wait) for r in b.column(n).to_pylist()]
            cols = [pa.array([getattr(x, c) for x in got], t) for c, t in OUTCOME.items()]
            yield pa.RecordBatch.from_arrays([*b.columns, *cols], names=[*b.schema.names, *OUTCOME])

    types = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in rows.schema.fields)
    out = rows.mapInArrow(run, f"{types}, status string, text string, error string, attempts int, finish_reason string, rejected string")
    said = {"prompt_sha256": F.lit(None if prompt is None else hashlib.sha256(prompt.encode()).hexdigest()), "model": F.lit(model), "profile": F.lit(profile)}
    out = out.withColumns({k: c.cast("string") for k, c in said.items()})
    return out.withColumn("input_sha256", F.sha2(F.coalesce("_request", F.lit("")), 256)).withColumn("output_sha256", F.sha2("text", 256)).drop("_request")


def recognise_in_order(pages: DataFrame, provider: Provider, *, attempts: int = 3, check: Callable[[str], list[str]] = page_errors) -> DataFrame:
    """Pages (book_id, page_no, md: the request) read in order, each with the last table header of the text made of the page before.

    Adds status, context and text. A page's context is there only if the page before has the number before and was read. A book is one
    task by nature; its pages are streamed."""

    def step(state: list, row: tuple | None) -> list[tuple]:
        if row is None:
            return []
        key, number, md = row
        last, made = state or (None, None)
        context = last_header(made) if made and last == number - 1 else ""
        got = call(provider, (md or "") + (f"\n\n{context}" if context else ""), attempts, check)
        state[:] = [number, got.text]
        return [(key, number, md, got.status, context, got.text)]

    text = [T.StructField(c, T.StringType()) for c in ("status", "context", "text")]
    return fold_pages(pages, "book_id", "page_no", "md", text, list, step)


def pending(pages: DataFrame, results: DataFrame, key: list[str], request: str) -> DataFrame:
    """Pages without an ok result for their present content."""
    now = pages.withColumn("input_sha256", F.sha2(F.coalesce(request, F.lit("")), 256))
    return unprocessed(now, results.where("status = 'ok'").select(*key, "input_sha256"), [*key, "input_sha256"])


def latest(results: DataFrame, key: list[str], at: str) -> DataFrame:
    """The newest record of each page: a later success takes away an older failure."""
    rest = [c for c in results.columns if c not in key]
    return results.groupBy(*key).agg(F.max_by(F.struct(*rest), at).alias("_r")).select(*key, "_r.*")


def table_context(pages: DataFrame, book: str, page: str, text: str) -> DataFrame:
    """Adds ``context``: the last table header of the page before, by number, so that a gap isn't bridged."""
    before = pages.select(book, (F.col(page) + 1).alias(page), pg.last_header(F.col(text)).alias("context"))
    return pages.join(before, [book, page], "left").withColumn("context", F.coalesce("context", F.lit("")))
