"""Language identification in two levels: the family first, then the language within it.

Families are told apart by one linear SVM each against the rest. Within a family every pair of
languages has its own linear SVM, and the language that wins most pairs is predicted. Both
levels read the same hashed byte n-grams of the whole text. The models are trained on a
bounded sample of labelled rows; text and label are all they learn from.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass, field
from itertools import combinations

import numpy as np
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from veildesk.llm.common import crc_bucket, id_field, map_rows
from veildesk.llm.linear import bounded_sample, features_of, hashed_ngrams, sigmoid, train_svm

#: Rows the models are trained on, over all languages together.
SAMPLE_ROWS = 2_400
UNKNOWN = "und"
# Families of closely related languages. A language of none is its own family.
FAMILIES = {
    "germanic": "af da de en fy is lb nb nl nn no sv",
    "romance": "ca es fr gl it oc pt ro",
    "slavic": "be bg bs cs hr mk pl ru sk sl sr uk",
    "uralic": "et fi hu",
    "turkic": "az kk ky tr tt uz",
    "semitic": "ar he mt",
    "indo-aryan": "bn gu hi mr ne pa ur",
}
_FAMILY_OF = {code: name for name, codes in FAMILIES.items() for code in codes.split()}
_TABLE = bytes(
    c + 32 if 65 <= c <= 90 else c if 97 <= c <= 122 or c >= 128 else 32 for c in range(256)
)
_SHARPNESS = 4.0


def prepare(text: str) -> bytes:
    """UTF-8 with A-Z lower-cased and everything in ASCII but letters made a space."""
    return b" " + text.encode().translate(_TABLE) + b" "


def has_letter(text: str | None) -> bool:
    return bool(text) and any(map(str.isalpha, text))


def family_of(language: str) -> str:
    return _FAMILY_OF.get(language.lower().split("-")[0].split("_")[0], language)


@dataclass
class LanguageModel:
    """``weights`` has a column for each family and for each pair within a family."""

    families: list[str] = field(default_factory=list)
    languages: dict[str, list[str]] = field(default_factory=dict)
    pairs: dict[str, list[tuple[int, int, int]]] = field(default_factory=dict)
    weights: np.ndarray = field(default_factory=lambda: np.zeros((1, 0), np.float32))

    def predict(self, text: str | None) -> tuple[str, float]:
        if not self.families or not has_letter(text):
            return UNKNOWN, 0.0
        margins = hashed_ngrams(prepare(text)) @ self.weights[:-1] + self.weights[-1]
        level = np.exp(_SHARPNESS * np.clip(margins[: len(self.families)], -5, 5))
        best = int(level.argmax())
        family = self.families[best]
        score = float(level[best] / level.sum()) if len(level) > 1 else 1.0
        languages = self.languages[family]
        if len(languages) == 1:
            return languages[0], score
        wins, trust = np.zeros(len(languages)), np.zeros(len(languages))
        for a, b, column in self.pairs[family]:
            sure = float(sigmoid(_SHARPNESS * margins[column]))
            wins[a if sure >= 0.5 else b] += 1
            trust[a] += sure
            trust[b] += 1 - sure
        # Most pairs won; ties go to the larger sum of the pairs' certainties, then the first.
        chosen = max(range(len(languages)), key=lambda k: (wins[k], trust[k], -k))
        return languages[chosen], score * float(trust[chosen]) / (len(languages) - 1)


def train(labels: list[str], x: np.ndarray) -> LanguageModel:
    """A model from labelled feature rows."""
    if not labels:
        return LanguageModel()
    given = np.array(labels, object)
    of = np.array([family_of(c) for c in labels], object)
    model = LanguageModel(families=sorted(set(of)))
    columns = []
    for family in model.families:
        alone = len(model.families) == 1
        columns.append(np.zeros(x.shape[1] + 1, np.float32) if alone else train_svm(x, of == family))
    for family in model.families:
        model.languages[family] = names = sorted(set(given[of == family]))
        model.pairs[family] = []
        for a, b in combinations(range(len(names)), 2):
            rows = (given == names[a]) | (given == names[b])
            model.pairs[family].append((a, b, len(columns)))
            columns.append(train_svm(x[rows], given[rows] == names[a]))
    model.weights = np.stack(columns, axis=1)
    return model


def fit(
    docs: DataFrame,
    training: Column,
    text_col: str = "text",
    lang_col: str = "lang",
    sample_rows: int = SAMPLE_ROWS,
) -> LanguageModel:
    """Learn from a bounded sample of the rows that ``training`` holds for.

    Rows without a label, and texts without a letter, teach nothing. Each language gives the
    same number of distinct texts, ``sample_rows`` shared among them, or all that it has.
    """
    given = docs.where(training & F.col(lang_col).isNotNull() & F.col(text_col).rlike("\\p{L}"))
    languages = given.select(lang_col).distinct().count()
    each = max(1, sample_rows // max(1, languages))
    sample = bounded_sample(given, F.col(lang_col), F.col(text_col), each)
    return train(*features_of(sample, prepare))


def identify(
    docs: DataFrame,
    training: Column | None = None,
    id_col: str = "doc_id",
    text_col: str = "text",
    lang_col: str = "lang",
    sample_rows: int = SAMPLE_ROWS,
) -> DataFrame:
    """``id_col, held_out, lang_pred, score`` for every document, from its whole text.

    By default the rows whose crc32 of the id (as text; a null id counts as empty text) leaves
    1 modulo 3 are held out and the model learns from the others. ``lang_pred`` is a learned
    label, or ``und`` with score 0 for a text that is null or has no letter, and for all texts
    if there was nothing to learn from. Rows are kept as they come, repeated ids included.
    """
    held_out = crc_bucket(id_col, 3) == 1 if training is None else ~training
    model = fit(docs, ~held_out, text_col, lang_col, sample_rows)
    schema = T.StructType(
        [
            id_field(docs, id_col),
            T.StructField("held_out", T.BooleanType()),
            T.StructField("lang_pred", T.StringType()),
            T.StructField("score", T.DoubleType()),
        ]
    )

    def rows(ids: list, out: list, texts: list) -> Iterator[tuple]:
        for key, held, text in zip(ids, out, texts, strict=True):
            yield (key, held, *model.predict(text))

    chosen = docs.select(F.col(id_col), held_out.alias("held_out"), F.col(text_col))
    return map_rows(chosen, rows, schema)
