"""Pluggable detectors, run once per distinct text inside Spark tasks."""

from __future__ import annotations

import hashlib
import re
import sys
import types
from collections.abc import Callable, Iterator, Mapping, Sequence
from dataclasses import dataclass, field
from typing import Protocol

import numpy as np
import pandas as pd
from pyspark import cloudpickle
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from veildesk.functions.text import probability
from veildesk.functions.windows import WINDOW_TOKENS, one_token, token_table, window_bounds
from veildesk.schemas import SPANS

Found = list[tuple[int, int, str]]


class Detector(Protocol):
    """What a detector offers. ``name`` is for messages; ``detector_digest`` tells two apart."""

    name: str

    def load(self) -> object: ...

    def detect(self, model: object, texts: list[str]) -> list[Found]: ...


@dataclass(frozen=True)
class GazetteerDetector:
    """Whole words looked up in a fixed vocabulary; deterministic, for tests and lists."""

    terms: Mapping[str, str]
    name: str = "gazetteer"

    def load(self) -> object:
        return re.compile(r"[^\W_]+")

    def detect(self, model: object, texts: list[str]) -> list[Found]:
        return [
            [
                (m.start(), m.end(), self.terms[m.group()])
                for m in model.finditer(text)
                if m.group() in self.terms
            ]
            for text in texts
        ]


@dataclass(frozen=True)
class TokenScoreDetector:
    """Token classifier around any scoring callable (an ONNX session, for example).

    A worker calls ``open_model`` once. What it returns is called with texts and their token
    tables and gives, for each window, logits of shape tokens x classes. Windows are scored one
    at a time unless ``batch`` says otherwise, so that results cannot depend on which windows a
    partition happens to bring together.
    """

    open_model: Callable[[], Callable]
    labels: Sequence[str]
    pieces: Callable[[str], list[int]] = one_token
    outside: int = 0
    threshold: float = 0.5
    batch: int = 1
    name: str = "token-scores"
    window: int = field(default=WINDOW_TOKENS)

    def load(self) -> object:
        return self.open_model()

    def detect(self, model: object, texts: list[str]) -> list[Found]:
        windows = []
        for number, text in enumerate(texts):
            tokens = token_table(text, self.pieces)
            windows += [
                (number, tokens[a:b]) for a, b in window_bounds(tokens, text, self.window)
            ]
        order = sorted(range(len(windows)), key=lambda i: len(windows[i][1]))
        labels: dict[int, list[str]] = {}
        for i in range(0, len(order), self.batch):
            some = order[i : i + self.batch]
            scores = model([texts[windows[w][0]] for w in some], [windows[w][1] for w in some])
            labels.update((w, self.label(s)) for w, s in zip(some, scores))
        found: list[Found] = [[] for _ in texts]
        for w, (number, tokens) in enumerate(windows):
            found[number] += [
                (int(start), int(end), label)
                for (start, end, _), label in zip(tokens, labels[w])
                if label != "O"
            ]
        return found

    def label(self, logits: np.ndarray) -> list[str]:
        scores = np.array(logits, dtype=float)  # a copy: the logits belong to the caller
        odds = np.exp(scores - scores.max(axis=1, keepdims=True))
        pii = 1 - odds[:, self.outside] / odds.sum(axis=1)
        scores[:, self.outside] = -np.inf
        threshold = probability(self.threshold)
        return [
            re.sub(r"\A[BIES]-", "", self.labels[best]) if p >= threshold else "O"
            for p, best in zip(pii, scores.argmax(axis=1))
        ]


def detector_digest(detector: Detector) -> str:
    """What a detector's answers depend on: its class, settings and functions, not its name."""
    return hashlib.sha256(cloudpickle.dumps(detector)).hexdigest()


def _model(detector: Detector, digest: str) -> object:
    """One model per detector and Python worker; a failed load raises and the retry tries again.

    Functions reach a task by value, with fresh globals each time, so the loaded models
    hang on ``sys.modules``, which lives as long as the worker.
    """
    models = sys.modules.setdefault("_veildesk_models", types.ModuleType("_veildesk_models"))
    if not hasattr(models, digest):
        setattr(models, digest, detector.load())
    return getattr(models, digest)


#: Characters of texts that a detector gets at once.
_CHARACTERS = 1 << 20


def _portions(batch: pd.DataFrame) -> Iterator[pd.DataFrame]:
    """A batch in parts of about ``_CHARACTERS``, so that the spans held at a time are bounded
    by text and not by a number of rows."""
    portion = np.cumsum([len(text or "") for text in batch["text"]]) // _CHARACTERS
    for _, part in batch.groupby(portion, sort=False):
        yield part.copy()


def run_detector(texts: DataFrame, detector: Detector) -> DataFrame:
    """Add ``spans`` to ``texts`` (columns ``digest, text``).

    Inference is slow per row, so rows are dealt to a fixed number of partitions: adaptive
    execution would merge them by their (small) size in bytes. Each partition is sorted by
    length, so that batches need little padding. A detector that fails, or leaves a text
    without an answer, fails the job: no text is ever passed on unscanned.
    """

    digest = detector_digest(detector)

    def work(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            for part in _portions(batch) if len(batch) else ():
                found = detector.detect(_model(detector, digest), part["text"].tolist())
                if len(found) != len(part) or any(f is None for f in found):
                    raise RuntimeError(f"detector {detector.name} returned no result for a text")
                part["spans"] = [
                    [{"start": s, "end": e, "type": t} for s, e, t in spans] for spans in found
                ]
                yield part

    partitions = int(texts.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    return (
        texts.select("digest", "text")
        .repartition(partitions, "digest")
        .sortWithinPartitions(F.length("text"))
        .mapInPandas(work, f"digest string, text string, spans {SPANS}")
    )
