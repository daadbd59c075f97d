"""Dense autoencoder over item feature vectors, trained data-parallel on Spark.

Architecture (reference defaults): ``in -> hidden (ReLU) -> latent (ReLU) ->
hidden (ReLU) -> in``, MSE loss, Adam (lr 1e-3), mini-batches of 256.

Training is synchronous and does not depend on how the rows are partitioned:
every epoch deals all rows into ``steps_per_epoch`` batches by a hash of the row
id.  Up to ``ROWS_ALONE`` rows an epoch is one job of one task.  Beyond, or with
dynamic allocation, a step is one job over the rows that the executors keep: each task sums its rows'
gradients (a few thousand numbers) and the driver adds them and applies Adam.
On request (``tasks``) an epoch is a barrier stage: its tasks hold their rows, exchange
the sums of a step's gradient and all apply the same
Adam update; the first hands the parameters on to the next epoch.  A lost task
restarts its epoch.  But Spark lets them wait a second for every exchange.
The input is a stage output, so nothing replays the feature pipeline.

Encoding and reconstruction are Arrow batch functions (``mapInPandas``) with
the parameters shipped in the closure.
"""

from __future__ import annotations

import base64
import math
from dataclasses import dataclass

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tastebud.sources.io import require_columns

HIDDEN_DIM = 128
LATENT_DIM = 32
EPOCHS = 50
LEARNING_RATE = 1e-3
BATCH_SIZE = 256
#: Batches per epoch.  The reference's batch of 256 rows would need a job per 256
#: rows; a fixed number of batches keeps the number of jobs independent of the input.
STEPS_PER_EPOCH = 16
#: Rows that are worth a barrier task, the most tasks of a barrier stage (each gets every other's sums), and the bytes of
#: rows that a task may hold.
ROWS_PER_TASK, MAX_TASKS, MAX_TASK_BYTES = 1 << 16, 64, 512 << 20
#: Rows that one task trains on alone: tasks that exchange sums wait for each other up to a second a step (Spark asks for the
#: others once a second), which is more than the products of so many rows take.
ROWS_ALONE = 1 << 20
#: Rows whose activations are held at once.
CHUNK_ROWS = 8192


@dataclass
class AeParams:
    layers: list  # [(W (out x in), b (out,)), ...] for the four linear layers

    @property
    def dims(self):
        return [self.layers[0][0].shape[1]] + [w.shape[0] for w, _ in self.layers]

    def flat(self) -> np.ndarray:
        return np.concatenate([np.concatenate([w.ravel(), b]) for w, b in self.layers])

    @staticmethod
    def from_flat(v: np.ndarray, dims: list[int]) -> "AeParams":
        out, at = [], 0
        for fi, fo in zip(dims[:-1], dims[1:]):
            w = v[at:at + fo * fi].reshape(fo, fi)
            at += fo * fi
            b = v[at:at + fo]
            at += fo
            out.append((w.copy(), b.copy()))
        return AeParams(out)


def layer_dims(input_dim: int, hidden: int = HIDDEN_DIM, latent: int = LATENT_DIM) -> list[int]:
    return [input_dim, hidden, latent, hidden, input_dim]


def init_params(input_dim: int, hidden: int = HIDDEN_DIM, latent: int = LATENT_DIM, seed: int = 42) -> AeParams:
    """Uniform(-1/sqrt(fan_in), 1/sqrt(fan_in)) weights and biases."""
    rng = np.random.RandomState(seed)
    dims = layer_dims(input_dim, hidden, latent)
    layers = []
    for fi, fo in zip(dims[:-1], dims[1:]):
        lim = 1.0 / math.sqrt(fi)
        layers.append((rng.uniform(-lim, lim, (fo, fi)), rng.uniform(-lim, lim, fo)))
    return AeParams(layers)


def formula_params(input_dim: int, hidden: int = HIDDEN_DIM, latent: int = LATENT_DIM) -> AeParams:
    """Fixed, closed-form weights (for checks an SQL engine can repeat).

    Layer ``L`` (1-based): ``W[o][i] = sin(1 + L + 0.37 o + 0.61 i) / sqrt(fan_in)``,
    ``b[o] = 0.1 cos(L + 0.5 o)``.
    """
    dims = layer_dims(input_dim, hidden, latent)
    layers = []
    for L, (fi, fo) in enumerate(zip(dims[:-1], dims[1:]), start=1):
        o = np.arange(fo, dtype=np.float64)[:, None]
        i = np.arange(fi, dtype=np.float64)[None, :]
        w = np.sin(1.0 + L + 0.37 * o + 0.61 * i) / math.sqrt(fi)
        b = 0.1 * np.cos(L + 0.5 * np.arange(fo, dtype=np.float64))
        layers.append((w, b))
    return AeParams(layers)


def _forward(p: AeParams, X: np.ndarray):
    acts = [X]
    h = X
    for li, (w, b) in enumerate(p.layers):
        h = h @ w.T + b
        if li < len(p.layers) - 1:
            h = np.maximum(h, 0.0)
        acts.append(h)
    return acts


def encode_array(p: AeParams, X: np.ndarray) -> np.ndarray:
    h = X
    for w, b in p.layers[:2]:
        h = np.maximum(h @ w.T + b, 0.0)
    return h


def _loss_and_grads(p: AeParams, X: np.ndarray):
    acts = _forward(p, X)
    y = acts[-1]
    diff = y - X
    loss = float(np.mean(diff * diff))
    g = 2.0 * diff / diff.size
    grads = [None] * len(p.layers)
    for li in range(len(p.layers) - 1, -1, -1):
        w, _ = p.layers[li]
        a_in = acts[li]
        grads[li] = (g.T @ a_in, g.sum(axis=0))
        if li > 0:
            g = (g @ w) * (acts[li] > 0)
    return loss, grads


def _stack(series: pd.Series) -> np.ndarray:
    return np.stack(series.to_numpy()).astype(np.float64) if len(series) else np.zeros((0, 0))


def training_input(df: DataFrame, id_col: str, vec_col: str) -> DataFrame:
    """Stage output ``(id, vec)`` that every training step reads."""
    from tastebud.session import materialize
    require_columns(df, [id_col, vec_col], "training vectors")
    return materialize(df.select(id_col, vec_col))


def dataset_loss(data: DataFrame, p: AeParams, vec_col: str = "vec") -> float:
    """Mean squared reconstruction error over all rows (one job)."""
    def part(batches):
        s, n = 0.0, 0
        for b in batches:
            X = _stack(b[vec_col])
            if len(X):
                y = _forward(p, X)[-1]
                s += float(np.sum((y - X) ** 2))
                n += X.size
        yield pd.DataFrame({"s": [s], "n": [n]})
    r = data.mapInPandas(part, "s double, n long").agg(F.sum("s").alias("s"), F.sum("n").alias("n")).first()
    if r["s"] is None:
        return 0.0
    return float(r["s"]) / max(1, int(r["n"]))


def batch_gradient(batch: DataFrame, p: AeParams, vec_col: str = "vec"):
    """``(gradient of the mean loss, mean loss, rows)`` of a batch: every task's sums, a few thousand numbers, added by the driver."""
    import pyarrow as pa
    width = p.dims[0]

    def part(batches):
        sums, n = 0.0, 0
        for b in batches:
            if b.num_rows:
                n += b.num_rows
                sums += _gradient_sums(p, b.column(vec_col).flatten().to_numpy(zero_copy_only=False).reshape(-1, width))
        if n:
            yield pa.RecordBatch.from_pydict({"sums": [sums]})

    rows = batch.select(F.col(vec_col).cast("array<double>").alias(vec_col))
    parts = [np.asarray(r.sums) for r in rows.mapInArrow(part, "sums array<double>").collect()]
    if not parts:
        return None, 0.0, 0
    total = sum(parts)
    n = int(total[-1])
    return total[:-2] / (n * width), float(total[-2]) / (n * width), n


@dataclass
class Adam:
    """The parameters and Adam's moments after ``t`` updates."""

    theta: np.ndarray
    m: np.ndarray
    v: np.ndarray
    t: int = 0

    def update(self, g: np.ndarray, lr: float) -> None:
        self.t += 1
        self.m = 0.9 * self.m + 0.1 * g
        self.v = 0.999 * self.v + 0.001 * g * g
        self.theta = self.theta - lr * (self.m / (1 - 0.9 ** self.t)) / (np.sqrt(self.v / (1 - 0.999 ** self.t)) + 1e-8)


def _gradient_sums(p: AeParams, X: np.ndarray) -> np.ndarray:
    """Gradient and loss summed over the cells of ``X``, and its rows, in one vector."""
    out = np.zeros(p.flat().size + 2)
    for a in range(0, len(X), CHUNK_ROWS):
        part = X[a:a + CHUNK_ROWS]
        loss, grads = _loss_and_grads(p, part)
        out += np.concatenate([*(np.concatenate([gw.ravel(), gb]) * part.size for gw, gb in grads),
                               [loss * part.size, len(part)]])
    return out


def _added_up(ctx, part: np.ndarray) -> np.ndarray:
    """The sum of all tasks' vectors, added in the order of the tasks, so every task gets the same numbers."""
    messages = ctx.allGather(base64.b64encode(part.tobytes()).decode())
    return sum(np.frombuffer(base64.b64decode(x)) for x in messages)


def barrier_tasks(data: DataFrame, width: int) -> int | None:
    """How many tasks train on ``data`` together; ``None`` if steps have to be jobs."""
    sc = data.sparkSession.sparkContext
    if sc.getConf().get("spark.dynamicAllocation.enabled", "false").lower() == "true":
        return None
    rows = data.count()
    if rows <= ROWS_ALONE and rows * width * 8 <= MAX_TASK_BYTES:
        return 1
    n = max(1, min(sc.defaultParallelism, MAX_TASKS, -(-rows // ROWS_PER_TASK)))
    return n if rows * width * 8 <= n * MAX_TASK_BYTES else None


def _epoch_by_barrier(data: DataFrame, vec_col: str, dealt, state: Adam, dims: list[int], steps: int, lr: float,
                      tasks: int) -> tuple[Adam, float, int]:
    """One epoch as one job: ``(state after it, loss sum, rows)``."""
    import pyarrow as pa
    from pyspark import BarrierTaskContext

    def run(batches):
        ctx = BarrierTaskContext.get()
        xs, ss = [np.zeros((0, dims[0]))], [np.zeros(0, np.int64)]
        for b in batches:
            xs.append(b.column(vec_col).flatten().to_numpy(zero_copy_only=False).reshape(-1, dims[0]))
            ss.append(b.column("step").to_numpy(zero_copy_only=False))
        s = np.concatenate(ss)
        order = np.argsort(s, kind="stable")
        X, at = np.concatenate(xs)[order], np.searchsorted(s[order], np.arange(steps + 1))
        adam, loss, rows = Adam(state.theta, state.m, state.v, state.t), 0.0, 0
        for step in range(steps):
            sums = _gradient_sums(AeParams.from_flat(adam.theta, dims), X[at[step]:at[step + 1]])
            sums = _added_up(ctx, sums) if tasks > 1 else sums
            n = int(sums[-1])
            if n:  # else no row was dealt to this batch
                adam.update(sums[:-2] / (n * dims[0]), lr)
                loss, rows = loss + sums[-2] / dims[0], rows + n
        if ctx.partitionId() == 0:
            yield pa.RecordBatch.from_pydict({"theta": [adam.theta], "m": [adam.m], "v": [adam.v], "t": [adam.t],
                                              "loss": [loss], "n": [rows]})

    rows = data.select(dealt.cast("long").alias("step"), F.col(vec_col).cast("array<double>").alias(vec_col)).repartition(tasks)
    r = rows.mapInArrow(run, "theta array<double>, m array<double>, v array<double>, t long, loss double, n long",
                        barrier=True).collect()[0]
    return Adam(np.array(r.theta), np.array(r.m), np.array(r.v), r.t), r.loss, r.n


def _step_tasks(data: DataFrame) -> int:
    """Tasks of a step's job: one per core, whose sums the driver adds."""
    return max(1, min(data.sparkSession.sparkContext.defaultParallelism, MAX_TASKS))


def _epoch_by_steps(data: DataFrame, vec_col: str, dealt, state: Adam, dims: list[int], steps: int,
                    lr: float) -> tuple[Adam, float, int]:
    """As :func:`_epoch_by_barrier`, a job per step."""
    loss, rows = 0.0, 0
    for step in range(steps):
        g, mean_loss, n = batch_gradient(data.where(dealt == step), AeParams.from_flat(state.theta, dims), vec_col)
        if n:
            state.update(g, lr)
            loss, rows = loss + mean_loss * n, rows + n
    return state, loss, rows


def train(data: DataFrame, input_dim: int, id_col: str = "item_id", vec_col: str = "vec",
          hidden: int = HIDDEN_DIM, latent: int = LATENT_DIM, epochs: int = EPOCHS, lr: float = LEARNING_RATE,
          steps_per_epoch: int = STEPS_PER_EPOCH, seed: int = 42, params: AeParams | None = None, tasks: int | None = None):
    """Train on ``data`` (see :func:`training_input`); returns ``(params, epoch_losses)``.

    ``tasks`` asks for so many barrier tasks (0: a job per step); by default it is one task, if :func:`barrier_tasks` says
    that it can hold the rows, else a job per step.
    """
    p = params or init_params(input_dim, hidden, latent, seed)
    theta, losses = p.flat(), []
    if data.isEmpty():
        return p, losses
    state = Adam(theta, np.zeros(theta.size), np.zeros(theta.size))
    if tasks is None:
        tasks = barrier_tasks(data, input_dim)
        tasks = tasks if tasks == 1 else 0  # a job takes less than the second that tasks wait for each other
    if not tasks:  # read by every step's job
        data = data.select(id_col, vec_col).repartition(_step_tasks(data)).persist()
    for epoch in range(epochs):
        dealt = F.pmod(F.xxhash64(F.lit(seed), F.lit(epoch), F.col(id_col)), F.lit(steps_per_epoch))
        if tasks:
            state, loss, rows = _epoch_by_barrier(data, vec_col, dealt, state, p.dims, steps_per_epoch, lr, tasks)
        else:
            state, loss, rows = _epoch_by_steps(data, vec_col, dealt, state, p.dims, steps_per_epoch, lr)
        losses.append(loss / max(1, rows))
    if not tasks:
        data.unpersist()
    return AeParams.from_flat(state.theta, p.dims), losses


def encode(df: DataFrame, p: AeParams, id_col: str = "item_id", vec_col: str = "vec",
           out_col: str = "vec") -> DataFrame:
    """``(id, latent vector)`` for every row (Arrow batches, numpy matmul)."""
    id_type = df.schema[id_col].dataType.simpleString()

    def run(batches):
        import pyarrow as pa
        for b in batches:
            if b.num_rows:
                X = b.column(vec_col).flatten().to_numpy(zero_copy_only=False).reshape(b.num_rows, -1)
                Z = encode_array(p, X)
                ends = pa.array(np.arange(0, Z.size + 1, Z.shape[1]), pa.int32())
                yield pa.RecordBatch.from_arrays([b.column(id_col), pa.ListArray.from_arrays(ends, pa.array(Z.ravel()))],
                                                 names=[id_col, out_col])

    rows = df.select(id_col, F.col(vec_col).cast("array<double>").alias(vec_col))
    return rows.mapInArrow(run, f"{id_col} {id_type}, {out_col} array<double>")


def reconstruction_error(df: DataFrame, p: AeParams, id_col: str = "item_id", vec_col: str = "vec") -> DataFrame:
    """``(id, mse)``: per-row mean squared reconstruction error."""
    id_type = df.schema[id_col].dataType.simpleString()

    def run(batches):
        for b in batches:
            X = _stack(b[vec_col])
            mse = np.mean((_forward(p, X)[-1] - X) ** 2, axis=1) if len(X) else np.zeros(0)
            yield pd.DataFrame({id_col: b[id_col].to_numpy(), "mse": mse})

    return df.select(id_col, vec_col).mapInPandas(run, f"{id_col} {id_type}, mse double")
