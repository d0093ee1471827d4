"""Bulk and query embedding behind one small protocol."""

from __future__ import annotations

import hashlib
import re
from collections.abc import Iterator, Sequence
from functools import lru_cache
from typing import Protocol

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from notegrove.functions.vectors import unit
from notegrove.schema import VECTOR_DIM

# Texts that are Python strings at once in a task.
TEXTS_AT_ONCE = 256


class Embedder(Protocol):
    """Anything that turns texts into rows of a float matrix. It is pickled to the tasks,
    so heavy state belongs in ``load``, which runs once per Python worker."""

    dim: int

    def load(self) -> None: ...

    def encode(self, texts: Sequence[str]) -> np.ndarray: ...


class HashedEmbedder:
    """Bag of hashed words of any script, scaled to unit length: deterministic and without a
    model. The words are those of ``functions.text.UNICODE_WORD``."""

    def __init__(self, dim: int = VECTOR_DIM, pattern: str = r"[^\W_]+(?:['’][^\W_]+)*"):
        self.dim = dim
        self.pattern = pattern

    def load(self) -> None:
        dim = self.dim

        # A cache for the frequent words; the size bounds it against rare ones.
        @lru_cache(maxsize=200_000)
        def slot(word: str) -> int:
            return int(hashlib.md5(word.encode()).hexdigest()[:7], 16) % dim

        self._slot = slot
        self._words = re.compile(self.pattern)

    def encode(self, texts: Sequence[str]) -> np.ndarray:
        out = np.zeros((len(texts), self.dim), dtype=np.float64)
        for i, text in enumerate(texts):
            slots = [self._slot(w) for w in self._words.findall(text)]
            if slots:
                out[i] = np.bincount(slots, minlength=self.dim)
        length = np.linalg.norm(out, axis=1, keepdims=True)
        return np.divide(out, length, out=out, where=length > 0)


class OnnxEmbedder:
    """A sentence model in ONNX form with its tokenizer file.

    A text longer than the model's input of ``max_tokens`` is read whole, window after
    window of (nearly) equal length; its vector is the mean of the windows' vectors,
    weighted by their tokens.
    ``pooling="first"`` takes the first token's row of the first output, ``"mean"`` the
    mean over the tokens. Both paths have to be readable by every executor (a shared
    mount, or files sent along with ``SparkContext.addFile``).
    """

    def __init__(
        self,
        model_path: str,
        tokenizer_path: str,
        dim: int = VECTOR_DIM,
        pooling: str = "first",
        max_tokens: int = 512,
        batch: int = 64,
    ):
        self.model_path = model_path
        self.tokenizer_path = tokenizer_path
        self.dim = dim
        self.pooling = pooling
        self.max_tokens = max_tokens
        self.batch = batch

    def load(self) -> None:
        try:
            import onnxruntime
            from tokenizers import Tokenizer
        except ImportError as e:
            raise RuntimeError("OnnxEmbedder needs onnxruntime and tokenizers") from e
        self._session = onnxruntime.InferenceSession(self.model_path)
        self._inputs = {i.name for i in self._session.get_inputs()}
        self._tokenizer = Tokenizer.from_file(self.tokenizer_path)
        self._tokenizer.no_truncation()
        self._tokenizer.no_padding()
        # What the tokenizer puts around every text goes around every window.
        around = self._tokenizer.encode("")
        plain = self._tokenizer.encode("a", add_special_tokens=False).ids
        marked = self._tokenizer.encode("a").ids
        at = next((i for i in range(len(marked)) if marked[i : i + len(plain)] == plain), 0)
        self._before = marked[:at] if around.ids and plain else []
        self._after = marked[at + len(plain) :] if around.ids and plain else []

    def _windows(self, text: str) -> list[list[int]]:
        ids = self._tokenizer.encode(text, add_special_tokens=False).ids
        room = max(1, self.max_tokens - len(self._before) - len(self._after))
        n = max(1, -(-len(ids) // room))
        cuts = [len(ids) * i // n for i in range(n + 1)]
        return [[*self._before, *ids[a:b], *self._after] for a, b in zip(cuts, cuts[1:])]

    def encode(self, texts: Sequence[str]) -> np.ndarray:
        out = np.zeros((len(texts), self.dim), dtype=np.float64)
        total = np.zeros(len(texts))
        pending: list[tuple[int, list[int]]] = []
        for i, text in enumerate(texts):
            for window in self._windows(text):
                pending.append((i, window))
                if len(pending) == self.batch:
                    self._add(pending, out, total)
                    pending = []
        if pending:
            self._add(pending, out, total)
        return out / np.maximum(total, 1)[:, None]

    def _add(self, windows: list[tuple[int, list[int]]], out: np.ndarray, total: np.ndarray) -> None:
        """Add each window's vector, weighted by its tokens, to its text's row."""
        width = max(1, max(len(w) for _, w in windows))
        ids = np.array([w + [0] * (width - len(w)) for _, w in windows], dtype=np.int64)
        mask = np.array([[1] * len(w) + [0] * (width - len(w)) for _, w in windows], dtype=np.int64)
        feed = {"input_ids": ids, "attention_mask": mask, "token_type_ids": np.zeros_like(ids)}
        states = self._session.run(None, {n: v for n, v in feed.items() if n in self._inputs})[0]
        if self.pooling == "first":
            rows = states[:, 0]
        else:
            weight = mask[:, :, None]
            rows = (states * weight).sum(axis=1) / np.maximum(weight.sum(axis=1), 1)
        tokens = np.maximum(mask.sum(axis=1), 1)
        at = [i for i, _ in windows]
        np.add.at(out, at, rows * tokens[:, None])
        np.add.at(total, at, tokens)


def stored_vectors(df: DataFrame, dim: int, vector_col: str = "vector") -> DataFrame:
    """``df`` with its vectors at unit length; a vector of another size stops the job."""
    size = F.size(vector_col)
    wrong = F.raise_error(F.concat(F.lit("vector size is not "), F.lit(str(dim))))
    checked = F.when(size == dim, F.col(vector_col)).otherwise(wrong.cast("array<float>"))
    return df.withColumn(vector_col, unit(checked))


def embed(
    df: DataFrame, text_col: str, embedder: Embedder, vector_col: str = "vector"
) -> DataFrame:
    """``df`` with the embedding of its lower-cased text; null text embeds as empty.

    The model is loaded once per Python worker and fed ``TEXTS_AT_ONCE`` texts at a time, so
    that a task holds few texts as Python strings, however many an Arrow batch has.
    """

    def run(batches: Iterator[pa.Array]) -> Iterator[pa.Array]:
        embedder.load()
        for texts in batches:
            matrix = np.empty((len(texts), embedder.dim), dtype=np.float32)
            for lo in range(0, len(texts), TEXTS_AT_ONCE):
                some = texts.slice(lo, TEXTS_AT_ONCE).to_pylist()
                matrix[lo : lo + len(some)] = embedder.encode(some)
            offsets = np.arange(len(texts) + 1, dtype=np.int32) * embedder.dim
            yield pa.ListArray.from_arrays(pa.array(offsets), pa.array(matrix.ravel()))

    # Declared here so that arrow_udf reads the iterator type from the hints.
    run.__annotations__ = {"batches": Iterator[pa.Array], "return": Iterator[pa.Array]}
    to_vector = F.arrow_udf(run, "array<float>")
    text = F.coalesce(F.lower(F.col(text_col)), F.lit(""))
    return df.withColumn(vector_col, to_vector(text))
