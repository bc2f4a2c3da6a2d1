"""Token counts of a byte-level BPE by finite-state machines."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F

from tidemark.llm.bpe import transducer
from tidemark.llm.pretokens import pretokens
from tidemark.llm.shared import Rolling, lean, text_slices


def count_tokens(docs: DataFrame, tokenizer: str, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """One row per row of ``docs``: id, ``n_bytes`` (UTF-8) and ``n_tokens`` of the whole text.

    ``tokenizer`` is the path, on every worker, of a vocabulary file of the tokenizers library with byte-level BPE. Its
    special strings count one each, as that library does by default. A null text is empty and has no tokens; ids, null
    or repeated, are carried along. No row depends on another, so nothing is shuffled.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        machine, rolling = transducer(tokenizer), Rolling(5)
        for batch in batches:
            for rows, data, bounds in text_slices(batch, "text"):
                starts, ends, row, _, _, signs = pretokens(data, bounds, machine.special)
                _, first, each = np.unique(rolling.spans(data, starts, ends), return_index=True, return_inverse=True)
                raw, count = data.tobytes(), machine.count
                counts = np.array([count(raw[i:j]) for i, j in zip(starts[first].tolist(), ends[first].tolist())])
                total = np.bincount(signs, minlength=len(rows)).astype(np.int64)
                if len(each):
                    total += np.bincount(row, weights=counts[each], minlength=len(rows)).astype(np.int64)
                columns = [rows.column(0), pa.array(np.diff(bounds)), pa.array(total)]
                yield pa.RecordBatch.from_arrays(columns, names=["id", "n_bytes", "n_tokens"])

    kind = docs.schema[id_col].dataType.simpleString()
    texts = docs.select(F.col(id_col).alias("id"), F.col(text_col).alias("text"))
    return texts.mapInArrow(lean(run), f"id {kind}, n_bytes bigint, n_tokens bigint").withColumnRenamed("id", id_col)
