"""A feed-forward classifier with ReLU layers and a softmax on top.

The reference's dense head (120, 84, k) on a flat feature vector, trained as the
linear classifier is (:mod:`quarry.operators.learn`): tasks run their Arrow
batches through the layers and back with numpy, Spark adds the gradients of all
layers up, and the driver, which holds the model alone, applies Adam or SGD.

Parameters lie in one flat vector: layer by layer, one row of input weights and
then the bias for each unit. A gradient's place in it names its layer and unit.
The derivative of the ReLU at 0 is 0.
"""

from __future__ import annotations

from collections.abc import Iterator, Sequence
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession

from .evaluate import BIAS
from .learn import class_labels, dense_rows, emitted_sums, log_sum_exp

# Fixed values of the reference's network.
HIDDEN = (120, 84)
ADAM_EPSILON = 1e-7


class Network:
    """Layers ``(weights u x i, biases u)``, all but the last followed by a ReLU."""

    def __init__(self, layers: Sequence[tuple[np.ndarray, np.ndarray]]):
        self.layers = [(np.asarray(W, np.float64), np.asarray(b, np.float64)) for W, b in layers]

    @property
    def sizes(self) -> tuple[int, ...]:
        return (self.layers[0][0].shape[1], *(len(b) for _, b in self.layers))

    @property
    def d(self) -> int:
        return self.sizes[0]

    @property
    def k(self) -> int:
        return self.sizes[-1]

    def logits(self, X: np.ndarray) -> np.ndarray:
        return self.activations(X)[-1]

    def activations(self, X: np.ndarray) -> list[np.ndarray]:
        """The input, each hidden layer's output, and the scores."""
        out = [X]
        for n, (W, b) in enumerate(self.layers):
            Z = out[-1] @ W.T + b
            out.append(Z if n == len(self.layers) - 1 else np.maximum(Z, 0.0))
        return out

    @classmethod
    def from_rule(cls, sizes: Sequence[int], rule) -> Network:
        """Weights ``rule(layer, unit, input)``; input -1 gives the bias."""
        layers = []
        for n, (i, u) in enumerate(zip(sizes[:-1], sizes[1:])):
            W = np.array([[rule(n, a, b) for b in range(i)] for a in range(u)], np.float64)
            layers.append((W, np.array([rule(n, a, BIAS) for a in range(u)], np.float64)))
        return cls(layers)

    @classmethod
    def random(cls, sizes: Sequence[int], seed: int = 0) -> Network:
        """Uniform weights within ``sqrt(6 / (inputs + units))``, biases 0; the same for the same seed."""
        rng = np.random.default_rng(seed)
        layers = []
        for i, u in zip(sizes[:-1], sizes[1:]):
            bound = np.sqrt(6.0 / (i + u))
            layers.append((rng.uniform(-bound, bound, (u, i)), np.zeros(u)))
        return cls(layers)

    def to_frame(self, spark: SparkSession) -> DataFrame:
        """Weight table ``(layer, unit, input, weight)``; input -1 is the bias."""
        rows = []
        for n, (W, b) in enumerate(self.layers):
            rows += [(n, u, i, float(W[u, i])) for u in range(W.shape[0]) for i in range(W.shape[1])]
            rows += [(n, u, BIAS, float(b[u])) for u in range(len(b))]
        return spark.createDataFrame(rows, "layer int, unit int, input int, weight double")

    @classmethod
    def from_frame(cls, weights: DataFrame) -> Network:
        """Read a weight table (model-sized)."""
        table = weights.select("layer", "unit", "input", "weight").toArrow()
        layer, unit, inp, w = (table.column(c).to_numpy() for c in range(4))
        layers = []
        for n in range(int(layer.max()) + 1):
            here = layer == n
            full = np.zeros((int(unit[here].max()) + 1, int(inp[here].max()) + 2))
            full[unit[here], inp[here]] = w[here]  # input -1, the bias, is the last column
            layers.append((full[:, :-1], full[:, -1]))
        return cls(layers)


def loss_gradient(network: Network, X: np.ndarray, y: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """The summed cross-entropy's gradient (flat), each row's loss, and whether it is right."""
    A = network.activations(X)
    Z, rows = A[-1], np.arange(len(y))
    lse = log_sum_exp(Z)
    D = np.exp(Z - lse[:, None])
    D[rows, y] -= 1.0
    parts = []
    for n in range(len(network.layers) - 1, -1, -1):
        parts.append(np.concatenate([D.T @ A[n], D.sum(axis=0)[:, None]], axis=1).ravel())
        if n:
            D = (D @ network.layers[n][0]) * (A[n] > 0)
    return np.concatenate(parts[::-1]), lse - Z[rows, y], Z.argmax(axis=1) == y


@dataclass(frozen=True)
class FeedForward:
    """The network as something :func:`quarry.operators.learn.train` can fit: ``sizes`` are
    the inputs, the hidden layers and the classes."""

    sizes: tuple[int, ...]

    @property
    def size(self) -> int:
        return sum(u * (i + 1) for i, u in zip(self.sizes[:-1], self.sizes[1:]))

    def flat(self, network: Network) -> np.ndarray:
        if network.sizes != tuple(self.sizes):
            raise ValueError(f"a network of sizes {network.sizes}; {tuple(self.sizes)} were asked for")
        return np.concatenate([np.concatenate([W, b[:, None]], axis=1).ravel() for W, b in network.layers])

    def model(self, theta: np.ndarray) -> Network:
        layers, at = [], 0
        for i, u in zip(self.sizes[:-1], self.sizes[1:]):
            full = theta[at : at + u * (i + 1)].reshape(u, i + 1)
            layers.append((full[:, :i], full[:, i]))
            at += u * (i + 1)
        return Network(layers)

    def start(self) -> np.ndarray:
        return self.flat(Network.random(self.sizes))

    def partials(self, theta: np.ndarray):
        """mapInArrow body over ``(features, label, batch)``: each mini-batch's summed gradient and metrics."""
        network = self.model(theta)
        d, k = network.d, network.k

        def fn(it: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            sums: dict[int, np.ndarray] = {}
            for part in it:
                if not part.num_rows:
                    continue
                X, y = dense_rows(part.column(0), d), class_labels(part.column(1), k)
                batches = part.column(2).to_numpy(zero_copy_only=False)
                for batch in np.unique(batches).tolist():
                    mine = batches == batch
                    g, loss, ok = loss_gradient(network, X[mine], y[mine])
                    found = np.concatenate([g, [mine.sum(), loss.sum(), ok.sum()]])
                    sums[batch] = sums[batch] + found if batch in sums else found
            yield from emitted_sums(sums)

        return fn
