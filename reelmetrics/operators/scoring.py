"""Batch scoring with a user-supplied model, loaded once per Python worker.

The model is any ``make()`` that returns ``predict(list of texts) -> list of results``; the
factory travels to the workers, the weights do not pass through the driver.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator

import pandas as pd
from pyspark import Accumulator
from pyspark.sql import Column, functions as F
from pyspark.sql.functions import pandas_udf

from reelmetrics.functions.sentiment import DEFAULT_LABEL, sentiment
from reelmetrics.functions.text import truncate

# Fixed value: texts per model call.
BATCH = 64

SPANS = "array<struct<label:string,text:string,score:double>>"


def _safe(predict: Callable, texts: list[str], default, failures: Accumulator | None) -> list:
    """Results of one batch; if it fails, each text alone, and the default for those that fail,
    which are counted."""
    try:
        return list(predict(texts))
    except Exception:
        out = []
        for text in texts:
            try:
                out.append(list(predict([text]))[0])
            except Exception:
                out.append(default)
                if failures is not None:
                    failures.add(1)
        return out


def scorer(
    make: Callable[[], Callable], kind: str, default=None, batch: int = BATCH, failures: Accumulator | None = None
) -> Callable[[Column], Column]:
    """A column function over texts with result type ``kind``; blank texts get ``default``.

    ``failures`` (a Spark accumulator) counts the texts on which the model failed, again for a
    task that runs again; look at it after the job, as these texts have the default, too.
    """

    def results(chunks: Iterator[pd.Series]) -> Iterator[list]:
        predict = make()
        for chunk in chunks:
            texts = chunk.fillna("").astype(str)
            wanted = [t for t in texts if t.strip()]
            scored = []
            for start in range(0, len(wanted), batch):
                scored += _safe(predict, wanted[start : start + batch], default, failures)
            left = iter(scored)
            yield [next(left) if t.strip() else default for t in texts]

    if kind.startswith("struct"):

        def run(chunks: Iterator[pd.Series]) -> Iterator[pd.DataFrame]:
            yield from (pd.DataFrame(rows) for rows in results(chunks))

    else:

        def run(chunks: Iterator[pd.Series]) -> Iterator[pd.Series]:
            yield from (pd.Series(rows, dtype=object) for rows in results(chunks))

    return pandas_udf(run, kind)


def embedding(make: Callable, text: Column, failures: Accumulator | None = None) -> Column:
    """Vector per text, NULL where there is none."""
    return scorer(make, "array<float>", failures=failures)(text)


def sentiment_scores(make: Callable, text: Column, chars: int | None = None, failures: Accumulator | None = None) -> Column:
    """``struct(label, conf, value)`` from a model giving ``{"label", "score"}`` per text."""
    raw = scorer(make, "struct<label:string,score:double>", {"label": DEFAULT_LABEL, "score": 0.0}, failures=failures)(
        truncate(text, chars)
    )
    return sentiment(raw["label"], raw["score"], text)


def entity_spans(make: Callable, text: Column, failures: Accumulator | None = None) -> Column:
    """Entity spans from a model giving a list of ``{"label", "text", "score"}`` per text."""
    return scorer(make, SPANS, [], failures=failures)(text)
