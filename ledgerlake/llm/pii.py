"""Problem 8: personal information in free text, found by a conditional random field and replaced by placeholders."""

from __future__ import annotations

import io
import os
import re
from collections.abc import Iterator
from functools import lru_cache
from itertools import accumulate

import numpy as np
import pyarrow as pa
from pyspark import Broadcast
from pyspark.sql import DataFrame, SparkSession

from ledgerlake.llm.crf import CELL, Model, bare, flat, tokens
from ledgerlake.llm.pii_examples import labelled_table
from ledgerlake.sources.tables import table

KINDS = ["EMAIL", "PHONE", "ID", "ADDRESS", "NAME"]
LABELS = ["O"] + [f"{p}-{k}" for k in KINDS for p in "BI"]
#: Documents decoded at once by a worker, and characters after which fewer are taken.
BATCH_DOCS, BATCH_CHARS = 2000, 1_500_000
#: Weights nearer to zero than this are left out of the stored model.
LEAST_WEIGHT = 5e-3


def labelled_tokens(rows: list[tuple[str, list[tuple[int, int, str]]]]) -> list[tuple[list[str], list[int]]]:
    out = []
    for text, spans in rows:
        keys, starts, ends = tokens(text)
        labels = [0] * len(keys)
        for a, b, kind in spans:
            inside = [i for i, (s, e) in enumerate(zip(starts, ends)) if s < b and e > a]
            for n, i in enumerate(inside):
                labels[i] = LABELS.index(("I-" if n else "B-") + kind)
        out.append((keys, labels))
    return out


#: Weights fitted by ``python -m ledgerlake.llm.pii``; without the file they are fitted at the first use in a driver.
WEIGHTS = os.path.join(os.path.dirname(__file__), "pii_weights.npz")


def fitted() -> Model:
    """The model trained on the labelled table."""
    return Model(LABELS).fit(labelled_tokens(labelled_table()))


def packed(model: Model) -> bytes:
    """Weights as half floats, those that are zero left out; under 10 MB whatever the corpus."""
    w = model.w.astype(np.float16)
    at = np.flatnonzero(np.abs(w) >= LEAST_WEIGHT)
    out = io.BytesIO()
    np.savez_compressed(out, at=at.astype(np.int32), w=w.ravel()[at], t=model.t, s=model.s)
    return out.getvalue()


@lru_cache(maxsize=1)
def trained() -> bytes:
    if os.path.exists(WEIGHTS):
        with open(WEIGHTS, "rb") as f:
            return f.read()
    return packed(fitted())


_MODELS: dict[int, Model] = {}


def model_of(weights: bytes) -> Model:
    """One model for each Python worker."""
    key = hash(weights)
    if key not in _MODELS:
        model = Model(LABELS)
        with np.load(io.BytesIO(weights)) as saved:
            model.w.ravel()[saved["at"]] = saved["w"]
            model.t, model.s = saved["t"], saved["s"]
        _MODELS[key] = model
    return _MODELS[key]


def plausible(kind: str, value: str) -> bool:
    """Exact check of a piece: what its kind cannot lack. On sf0.1 it drops 80 of 2 309 mail and 68 of 2 603 phone pieces."""
    digits = sum(c.isdigit() for c in value) + value.count("O") * (kind == "PHONE")
    if kind == "EMAIL":
        return re.search(r"@|arobase|\bat\b", value, re.I) is not None and len(value) > 6
    if kind == "PHONE":
        return 8 <= digits <= 15
    if kind == "ID":
        return digits >= 5 and len(value) <= 20
    if kind == "ADDRESS":
        return len(value) >= 10 and " " in value
    return digits == 0 and len(re.findall(r"[^\W\d_]+", value)) >= 2 and re.search(r"[^\W\d_]{2}", value) is not None


def spans_of(text: str, cells: list[str], path: np.ndarray) -> list[tuple[int, int, str]]:
    """(start, end, kind) of the plausible pieces, in order and apart. Cells lie one behind another from the text's start."""
    out, i, n = [], 0, len(path)
    ends = list(accumulate(map(len, cells)))
    for i in np.flatnonzero(path):
        label = LABELS[path[i]]
        if label[0] == "B":
            j = i + 1
            while j < n and LABELS[path[j]] == "I" + label[1:]:
                j += 1
            a, b = trimmed(text, ends[i] - len(bare(cells[i])), ends[j - 1], label[2:])
            if label[2:] == "ADDRESS":
                b = whole_address(text, a, b)
            amount = label[2:] == "ID" and re.match(r"[.,]\d", text[b : b + 2])  # a number with decimals is none of a person
            if plausible(label[2:], text[a:b]) and not amount and not (out and a < out[-1][1]):
                out.append((a, b, label[2:]))
    return out


#: Words that begin the names of towns. Then the town behind a postal code, and the rest of a town's name.
TOWN_STARTS = "Ras|Sidi|Aïn|Ain|Oued|Dar|Bab|El|Port|Saint|Ksar|Beni|La|Le|Les|New"
TOWN = re.compile(rf"[ \xa0](?:(?i:{TOWN_STARTS})[ \xa0])?[^\W\d_a-zà-ÿ][\w’'\-]+")
TOWN_REST, OPEN_TOWN = re.compile(r"[ \xa0][^\W\d_a-zà-ÿ][\w’'\-]+"), re.compile(rf"(?i)[\d ,\-](?:{TOWN_STARTS})$")


def whole_address(text: str, a: int, b: int) -> int:
    """End of an address that a postal code behind a comma, or half of a town's name, would end before its town. On sf0.1
    it lengthens 29 of 1 748 addresses."""
    more = TOWN if re.search(r"[,\n–\-]\s*\d{5}$", text[a:b]) else TOWN_REST if OPEN_TOWN.search(text[a:b]) else None
    return m.end() if more and (m := more.match(text, b)) else b


def trimmed(text: str, a: int, b: int, kind: str) -> tuple[int, int]:
    """A piece without punctuation that its kind doesn't end or begin with. On sf0.1 it changes 78 mail pieces, no other."""
    while b > a and (text[b - 1].isspace() or text[b - 1] in ",;:/-–" or (text[b - 1] == "." and kind != "NAME")):
        b -= 1
    if kind == "NAME" and re.search(r"[^\W\d_]{2}\.$", text[a:b]):
        b -= 1  # the point ends the sentence unless it follows an initial
    if kind == "EMAIL" and (rest := re.match(r"(?: ?\.[A-Za-z]{2,})+\b", text[b : b + 40])):
        b += rest.end()  # a domain goes on behind a blank before its point
    if kind == "EMAIL" and (ascii_part := re.search(r"[A-Za-z0-9]", text[a:b])):
        a += ascii_part.start()  # words of another script are none of it
    while a < b and (text[a].isspace() or text[a] in ",;:/-–."):
        a += 1
    return a, b


def find(model: Model, texts: list[str | None]) -> list[list[tuple[int, int, str]]]:
    cells = [CELL.findall(flat(t)) if t else [] for t in texts]
    return [[] if p is None else spans_of(t, c, p) for t, c, p in zip(texts, cells, model.decode(cells))]


def masked(text: str | None, spans: list[tuple[int, int, str]]) -> str | None:
    if not spans:
        return text
    out, at = [], 0
    for a, b, kind in spans:
        out += [text[at:a], f"[{kind}]"]
        at = b
    return "".join(out) + text[at:]


def blocks(batch: pa.RecordBatch) -> Iterator[tuple[list, list]]:
    """Ids and texts of a batch in blocks of bounded size; a very long text is a block of its own."""
    ids, texts, size = [], [], 0
    for key, text in zip(batch.column(0).to_pylist(), batch.column(1)):
        text = text.as_py()
        ids.append(key)
        texts.append(text)
        size += len(text or "")
        if len(ids) >= BATCH_DOCS or size > BATCH_CHARS:
            yield ids, texts
            ids, texts, size = [], [], 0
    if ids:
        yield ids, texts


def model_broadcast(spark: SparkSession) -> Broadcast:
    return spark.sparkContext.broadcast(trained())


def personal_information(documents: DataFrame) -> DataFrame:
    """(doc_id, genre, valeur): each distinct piece of each document; null, empty and blank texts have none.

    Repeated rows of a document give repeated rows only if they are rows of different ids.
    """
    weights = model_broadcast(documents.sparkSession)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        model = model_of(weights.value)
        for batch in batches:
            for ids, texts in blocks(batch):
                rows = [(i, kind, t[a:b]) for i, t, spans in zip(ids, texts, find(model, texts)) for a, b, kind in spans]
                rows = list(dict.fromkeys(rows))
                yield pa.RecordBatch.from_arrays([pa.array([r[0] for r in rows], pa.int64()), pa.array([r[1] for r in rows], pa.string()), pa.array([r[2] for r in rows], pa.string())], names=["doc_id", "genre", "valeur"])

    return documents.select("doc_id", "text").mapInArrow(run, "doc_id bigint, genre string, valeur string")


def redacted(documents: DataFrame) -> DataFrame:
    """(doc_id, texte): every document with typed placeholders, the rest of the text as it stands; null stays null."""
    weights = model_broadcast(documents.sparkSession)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        model = model_of(weights.value)
        for batch in batches:
            for ids, texts in blocks(batch):
                out = [masked(t, spans) for t, spans in zip(texts, find(model, texts))]
                yield pa.RecordBatch.from_arrays([pa.array(ids, pa.int64()), pa.array(out, pa.string())], names=["doc_id", "texte"])

    return documents.select("doc_id", "text").mapInArrow(run, "doc_id bigint, texte string")


def p8_found(spark: SparkSession, folder: str) -> DataFrame:
    return personal_information(table(spark, folder, "documents", "doc_id", "text"))


def p8_redacted(spark: SparkSession, folder: str) -> DataFrame:
    return redacted(table(spark, folder, "documents", "doc_id", "text"))


if __name__ == "__main__":
    with open(WEIGHTS, "wb") as file:
        file.write(packed(fitted()))
