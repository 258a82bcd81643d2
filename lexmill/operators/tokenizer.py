"""What every tokenizer offers to the operators."""

from __future__ import annotations

from typing import Protocol

from pyspark.sql import Column


class Tokenizer(Protocol):
    """Chosen by the caller; character and byte-pair tokenizers follow it."""

    vocab_size: int
    bos: int
    eos: int
    unk: int
    pad: int

    def encode(self, text: Column, bos: bool = False, eos: bool = False) -> Column: ...

    def decode(self, ids: Column) -> Column: ...

    def sql_functions(self) -> dict[str, str]:
        """Signatures and bodies of SQL functions."""
        ...

    def python_functions(self) -> dict:
        """Names and functions of what SQL cannot express."""
        ...
