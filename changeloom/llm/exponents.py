"""exp of many float32 numbers, by onnxruntime's kernel.

numpy's is fast only where the processor has AVX-512; with AVX2 it takes several times as long as this one, which
is closer to the exact values too. A call costs as much as some ten thousand numbers, so small arrays go to
numpy, as do other types, and all where onnxruntime is missing.
"""

from __future__ import annotations

from collections.abc import Callable
from functools import lru_cache

import numpy as np

LARGE = 1 << 15  # numbers that are worth a call
FLOAT = 1  # ONNX's number of float32


def _number(n: int) -> bytes:
    """As protobuf writes it: seven bits a byte, the lowest first."""
    return bytes([n]) if n < 128 else bytes([n & 127 | 128]) + _number(n >> 7)


def _field(key: int, value: int | str | bytes) -> bytes:
    if isinstance(value, int):
        return _number(key << 3) + _number(value)
    value = value.encode() if isinstance(value, str) else value
    return _number(key << 3 | 2) + _number(len(value)) + value


def exp_model() -> bytes:
    """An ONNX model: y is Exp of x, both of one axis of any length."""
    axis = _field(1, _field(2, "n"))
    floats = _field(2, _field(1, _field(1, FLOAT) + _field(2, axis)))
    node = _field(1, "x") + _field(2, "y") + _field(4, "Exp")
    graph = _field(1, node) + _field(2, "exp") + _field(11, _field(1, "x") + floats) + _field(12, _field(1, "y") + floats)
    return _field(1, 8) + _field(7, graph) + _field(8, _field(1, "") + _field(2, 13))  # versions of the format and of its operators


@lru_cache(maxsize=1)
def _kernel() -> Callable[[np.ndarray], None] | None:
    try:
        import onnxruntime
    except ImportError:
        return None
    options = onnxruntime.SessionOptions()
    options.intra_op_num_threads = options.inter_op_num_threads = 1  # a task has one core
    options.enable_cpu_mem_arena = False
    session = onnxruntime.InferenceSession(exp_model(), options, providers=["CPUExecutionProvider"])
    binding = session.io_binding()

    def run(values: np.ndarray) -> None:
        own = "cpu", 0, np.float32, (values.size,), values.ctypes.data
        binding.bind_input("x", *own)
        binding.bind_output("y", *own)
        session.run_with_iobinding(binding)

    return run


def exp(values: np.ndarray) -> None:
    """Every number of the array becomes its exp."""
    fits = values.size >= LARGE and values.dtype == np.float32 and values.flags.c_contiguous
    kernel = _kernel() if fits else None
    if kernel:
        kernel(values)
    else:
        np.exp(values, out=values)
