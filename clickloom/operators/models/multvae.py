"""Variational autoencoder with a multinomial likelihood over user histories.

Training is data parallel and synchronous: logical shards of one global batch sum their
gradients, the sums are added shard by shard, and one Adam update follows. Steps wait for each
other, so a job a step costs more than a small step itself: the users of an epoch are dealt to
groups of consecutive steps, and where a step is small, a task takes the steps of one group.
Where it is large, a job takes one step, with its shards on all cores and the update on the
driver. Both give the same model; the driver holds it and its moments only.
"""

from __future__ import annotations

import math
from collections.abc import Iterator, Sequence
from dataclasses import dataclass

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from clickloom.operators.scoring import _seen_cells, densify, score_histories
from clickloom.session import drop_folder, materialize, scratch_path

SHARDS = 32
"""Logical shards of a batch; part of the model, not of the cluster."""

SLICE = 1 << 16
"""Weights per summed piece: one group holds a piece of every shard, 16 MB."""

GROUP_ENTRIES = 2_000_000
"""History entries of a group of steps, 16 MB."""

STEP_WORK = 1 << 28
"""Users times weights of a step, from which on its shards are dealt over the cores."""

Weights = dict[str, np.ndarray]


@dataclass(frozen=True)
class VaeModel:
    weights: Weights
    depth: int
    n_items: int
    losses: list[float]


def layer_sizes(n_items: int, dims: Sequence[int]) -> list[tuple[str, int, int]]:
    """(name, inputs, outputs) of all layers; the encoder ends in mean and log-variance."""
    *hidden, latent = dims
    down = [n_items, *hidden, 2 * latent]
    up = [latent, *reversed(hidden), n_items]
    return [
        (f"{side}{i}", a, b)
        for side, path in (("e", down), ("d", up))
        for i, (a, b) in enumerate(zip(path, path[1:]))
    ]


def init_weights(n_items: int, dims: Sequence[int], seed: int) -> Weights:
    """Glorot-normal weights, small random biases."""
    rng = np.random.default_rng(seed)
    weights = {}
    for name, a, b in layer_sizes(n_items, dims):
        weights[f"{name}.w"] = rng.normal(0, math.sqrt(2 / (a + b)), (a, b)).astype(np.float32)
        weights[f"{name}.b"] = rng.normal(0, 1e-3, b).astype(np.float32)
    return weights


def anneal(step: float, total: int, beta: float, schedule: str = "linear") -> float:
    """KL weight after a number of steps; no warm-up when ``total`` is not positive."""
    if schedule not in ("linear", "cosine"):
        raise ValueError(f"unknown schedule {schedule!r}")
    if total <= 0:
        return beta
    t = min(1.0, step / total)
    return beta * (t if schedule == "linear" else (1 - math.cos(math.pi * t)) / 2)


def _walk(h: np.ndarray, weights: Weights, side: str, depth: int) -> list[np.ndarray]:
    """Activations of one half, tanh between layers."""
    path = [h]
    for i in range(depth):
        h = h @ weights[f"{side}{i}.w"] + weights[f"{side}{i}.b"]
        if i < depth - 1:
            h = np.tanh(h)
        path.append(h)
    return path


def _unit(x: np.ndarray) -> np.ndarray:
    return x / np.maximum(np.linalg.norm(x, axis=1, keepdims=True), 1e-12)


def logits(x: np.ndarray, weights: Weights, depth: int) -> np.ndarray:
    """Scores of all items at the posterior mean."""
    top = _walk(_unit(x), weights, "e", depth)[-1]
    return _walk(top[:, : top.shape[1] // 2], weights, "d", depth)[-1]


def _retrace(grad: np.ndarray, path: list, weights: Weights, side: str, grads: Weights) -> np.ndarray:
    """Gradients of one half, from its output back to its input."""
    depth = len(path) - 1
    for i in reversed(range(depth)):
        if i < depth - 1:
            grad = grad * (1 - path[i + 1] ** 2)
        grads[f"{side}{i}.w"] = path[i].T @ grad
        grads[f"{side}{i}.b"] = grad.sum(axis=0)
        if i or side == "d":
            grad = grad @ weights[f"{side}{i}.w"].T
    return grad


def loss_and_gradients(
    x: np.ndarray, weights: Weights, depth: int, beta: float, mask: np.ndarray, noise: np.ndarray
) -> tuple[float, Weights]:
    """Mean negative log-likelihood plus ``beta`` KL, for given dropout mask and noise."""
    rows = len(x)
    down = _walk(_unit(x) * mask, weights, "e", depth)
    latent = down[-1].shape[1] // 2
    mu, logvar = down[-1][:, :latent], down[-1][:, latent:]
    spread = np.exp(0.5 * logvar)
    up = _walk(mu + noise * spread, weights, "d", depth)
    shifted = up[-1] - up[-1].max(axis=1, keepdims=True)
    logp = shifted - np.log(np.exp(shifted).sum(axis=1, keepdims=True))
    kl = -0.5 * (1 + logvar - mu**2 - np.exp(logvar)).sum(axis=1)
    loss = float((-(logp * x).sum(axis=1) + beta * kl).mean())
    grads: Weights = {}
    dz = _retrace(
        (np.exp(logp) * x.sum(axis=1, keepdims=True) - x) / rows, up, weights, "d", grads
    )
    dmu = dz + beta * mu / rows
    dlogvar = dz * noise * spread * 0.5 + beta * 0.5 * (np.exp(logvar) - 1) / rows
    _retrace(np.hstack([dmu, dlogvar]), down, weights, "e", grads)
    return loss, grads


def _adam(weights: Weights, state: Weights, grads: Weights, step: int, lr: float, decay: float) -> None:
    """One Adam update in place, with decoupled weight decay."""
    for name, g in grads.items():
        m, v = state[f"m:{name}"], state[f"v:{name}"]
        m += 0.1 * (g - m)
        v += 0.001 * (g * g - v)
        if decay:
            weights[name] *= 1 - lr * decay
        weights[name] -= (
            lr * (m / (1 - 0.9**step)) / (np.sqrt(v / (1 - 0.999**step)) + 1e-8)
        ).astype(np.float32)


def fit_multvae(
    histories: DataFrame,
    n_items: int,
    dims: Sequence[int] = (600, 200),
    dropout: float = 0.5,
    beta: float = 0.2,
    epochs: int = 30,
    batch_size: int = 256,
    lr: float = 1e-3,
    weight_decay: float = 0.0,
    total_anneal_steps: int = 200_000,
    kl_schedule: str = "linear",
    use_lr_scheduler: bool = True,
    seed: int = 42,
    tasks: int | None = None,
) -> VaeModel:
    """Train on ``(user_id, item_idx[], weight[])`` rows.

    Synchronous data-parallel steps: the users of a global batch (drawn by a hash, anew in
    every epoch) are dealt over a fixed number of logical shards, each shard sums its
    gradients, the sums are added in order, and one Adam update follows. The model does
    not depend on the number of tasks, nor on which steps share a job. KL warm-up and the cosine learning-rate decay (to a
    hundredth) advance with the steps.
    """
    spark = histories.sparkSession
    depth = len(dims)
    weights = init_weights(n_items, dims, seed)
    shard = F.pmod(F.xxhash64("user_id", F.lit(seed)), F.lit(SHARDS)).cast("int")
    data = materialize(
        histories.select("user_id", "item_idx", "weight", shard.alias("shard")), "vae"
    )
    n_users, entries = data.agg(F.count("*"), F.sum(F.size("item_idx"))).first()
    steps = max(1, -(-n_users // batch_size))
    size = max(1, min(steps, GROUP_ENTRIES * steps // max(entries or 0, 1)))
    plan = _Plan(
        depth, n_items, dims[-1], dropout, beta, steps, epochs, lr, weight_decay,
        total_anneal_steps, kl_schedule, use_lr_scheduler, seed,
    )
    state = {f"{k}:{n}": np.zeros_like(w) for n, w in weights.items() for k in "mv"}
    small = max(batch_size, 64) * sum(w.size for w in weights.values()) < STEP_WORK
    losses = []
    for epoch in range(epochs):
        total = 0.0
        turn = F.pmod(F.xxhash64("user_id", F.lit(seed + 1 + epoch)), F.lit(steps)).cast("int")
        dealt = data.withColumn("turn", turn).withColumn("part", F.expr(f"int(turn div {size})"))
        path = scratch_path(spark, "vae-epoch")
        dealt.repartition("part").write.partitionBy("part").parquet(path)
        stored = spark.read.schema(dealt.schema).parquet(path)
        for part in range(-(-steps // size)):
            rows = stored.where(F.col("part") == part)
            if small:
                found = _steps_in_task(rows, weights, state, plan, epoch)
            else:
                turns = range(part * size, min(steps, (part + 1) * size))
                found = _steps_over_shards(rows, turns, weights, state, plan, epoch, tasks)
            for loss in found:
                total += loss
        drop_folder(path)
        losses.append(total / max(n_users, 1))
    return VaeModel(weights, depth, n_items, losses)


@dataclass(frozen=True)
class _Plan:
    """What a step needs besides its users, the weights and the moments."""

    depth: int
    n_items: int
    latent: int
    dropout: float
    beta: float
    steps: int
    epochs: int
    lr: float
    decay: float
    warm_up: int
    schedule: str
    scheduled: bool
    seed: int

    def kl(self, step: int) -> float:
        return anneal(step + 1, self.warm_up, self.beta, self.schedule)

    def update(self, weights: Weights, state: Weights, sums: Weights, users: int, step: int) -> None:
        rate = self.lr
        if self.scheduled:
            turned = math.cos(math.pi * min(1.0, step / (self.steps * self.epochs)))
            rate = self.lr / 100 + (self.lr - self.lr / 100) * (1 + turned) / 2
        grads = {n: (g / users).astype(np.float32) for n, g in sums.items()}
        _adam(weights, state, grads, step + 1, rate, self.decay)


def _shard_sums(
    items: Sequence, values: Sequence, number: int, weights: Weights, plan: _Plan, epoch: int, at: int
) -> tuple[float, Weights]:
    """Loss and gradients of a shard's users in a step, summed in the order they come in.

    A shard draws its dropout and noise from a generator of its own.
    """
    rng = np.random.default_rng([plan.seed, epoch, at, number])
    kl = plan.kl(epoch * plan.steps + at)
    sums: dict[str, np.ndarray] = {}
    loss_sum = 0.0
    for start in range(0, len(items), 256):
        x = densify(items[start : start + 256], values[start : start + 256], plan.n_items)
        mask = (rng.random(x.shape, dtype=np.float32) >= plan.dropout) / (1.0 - plan.dropout)
        noise = rng.standard_normal((len(x), plan.latent)).astype(np.float32)
        loss, grads = loss_and_gradients(
            x, weights, plan.depth, kl, mask.astype(np.float32), noise
        )
        loss_sum += loss * len(x)
        for name, g in grads.items():
            sums[name] = sums.get(name, 0.0) + g.astype(np.float64) * len(x)
    return loss_sum, sums


def _steps_in_task(
    rows: DataFrame, weights: Weights, state: Weights, plan: _Plan, epoch: int
) -> list[float]:
    """Take the steps of one group in one task; losses of the steps. Changes weights and state.

    Shards are added up in the order of their numbers, as by :func:`_steps_over_shards`.
    """
    shared = rows.sparkSession.sparkContext.broadcast({**weights, **state})

    def train(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        frames = list(batches)
        if not frames:
            return
        frame = pd.concat(frames).sort_values(["turn", "shard", "user_id"])
        model = {name: array.copy() for name, array in shared.value.items()}
        own = {name: model[name] for name in weights}
        turns, shards = frame["turn"].to_numpy(), frame["shard"].to_numpy()
        items, values = frame["item_idx"].to_numpy(), frame["weight"].to_numpy()
        ends = np.flatnonzero((np.diff(turns) != 0) | (np.diff(shards) != 0)) + 1
        cuts = [0, *ends.tolist(), len(frame)]
        losses, loss, users, sums = [], 0.0, 0, {}
        for a, z in zip(cuts, cuts[1:]):
            at = int(turns[a])
            found, grads = _shard_sums(items[a:z], values[a:z], int(shards[a]), own, plan, epoch, at)
            loss, users = loss + found, users + z - a
            for name, g in grads.items():
                sums[name] = sums.get(name, 0.0) + g
            if z == len(frame) or turns[z] != at:
                plan.update(own, model, sums, users, epoch * plan.steps + at)
                losses.append(loss)
                loss, users, sums = 0.0, 0, {}
        out = [("loss", 0, np.array(losses).tobytes())]
        for name, array in model.items():
            flat = array.ravel()
            for at in range(0, flat.size, SLICE):
                out.append((name, at, flat[at : at + SLICE].tobytes()))
        yield pd.DataFrame(out, columns=["name", "at", "v"])

    losses: list[float] = []
    made = rows.coalesce(1).mapInPandas(train, "name string, at long, v binary")
    for row in made.toLocalIterator():  # the model and its moments
        if row["name"] == "loss":
            losses = np.frombuffer(row["v"], np.float64).tolist()
            continue
        target = (weights if row["name"] in weights else state)[row["name"]].reshape(-1)
        values = np.frombuffer(row["v"], target.dtype)
        target[row["at"] : row["at"] + len(values)] = values
    shared.destroy()
    return losses


def _steps_over_shards(
    rows: DataFrame,
    turns: range,
    weights: Weights,
    state: Weights,
    plan: _Plan,
    epoch: int,
    tasks: int | None,
) -> Iterator[float]:
    """Take steps one by one, each with its shards in tasks of their own and the update here."""
    sc = rows.sparkSession.sparkContext
    # Kept dealt by logical shard, so a step shuffles gradient sums only; lost blocks are
    # rebuilt from the stored table.
    kept = rows.repartition(tasks or sc.defaultParallelism, "shard").persist()
    for at in turns:
        shared = sc.broadcast(weights)
        sums = _shard_gradients(kept.where(F.col("turn") == at), shared, plan, epoch, at)
        loss, users, found = _collect_sums(sums, weights)
        shared.destroy()
        if users:
            plan.update(weights, state, found, users, epoch * plan.steps + at)
            yield loss
    kept.unpersist()


SUMS = "shard int, name string, at long, v binary, n long"


def _shard_gradients(data: DataFrame, shared, plan: _Plan, epoch: int, at: int) -> DataFrame:
    """Gradient sums of one global batch, summed over its shards in the order of their numbers.

    A shard takes its users in order of their ids, so the sums do not depend on tasks or Arrow
    batches.
    """

    def gradients(part: pd.DataFrame) -> pd.DataFrame:
        part = part.sort_values("user_id")
        number = int(part["shard"].iloc[0])
        items, values = part["item_idx"].to_numpy(), part["weight"].to_numpy()
        loss_sum, sums = _shard_sums(items, values, number, shared.value, plan, epoch, at)
        out = [(number, "loss", 0, np.array([loss_sum]).tobytes(), len(part))]
        for name, array in sums.items():
            flat = array.ravel()
            for start in range(0, flat.size, SLICE):
                piece = flat[start : start + SLICE].tobytes()
                out.append((number, name, start, piece, len(part)))
        return pd.DataFrame(out, columns=["shard", "name", "at", "v", "n"])

    def add_up(pieces: pd.DataFrame) -> pd.DataFrame:
        pieces = pieces.sort_values("shard")
        total = sum(np.frombuffer(v, dtype=np.float64) for v in pieces["v"])
        first = pieces.iloc[:1]
        return first.assign(v=[total.tobytes()], n=[pieces["n"].sum()])

    parts = data.groupBy("shard").applyInPandas(gradients, SUMS)
    return parts.groupBy("name", "at").applyInPandas(add_up, SUMS)


def _collect_sums(sums: DataFrame, weights: Weights) -> tuple[float, int, Weights]:
    """(loss sum, users, gradient sums): as large as the model, whatever the users."""
    loss, rows, grads = 0.0, 0, {}
    for row in sums.toLocalIterator():
        values = np.frombuffer(row["v"], dtype=np.float64)
        if row["name"] == "loss":
            loss, rows = float(values[0]), row["n"]
            continue
        shape = weights[row["name"]].shape
        target = grads.setdefault(row["name"], np.zeros(shape))
        target.reshape(-1)[row["at"] : row["at"] + len(values)] = values
    return loss, rows, grads


def recommend_multvae(
    model: VaeModel,
    histories: DataFrame,
    items: DataFrame,
    k: int = 15,
    filter_seen: bool = True,
) -> DataFrame:
    """(user_id, item_id, score) from one forward pass per user; ``items`` has item_idx."""
    shared = histories.sparkSession.sparkContext.broadcast(model.weights)
    depth = model.depth
    best = score_histories(
        histories, model.n_items, lambda x: logits(x, shared.value, depth), k, filter_seen
    )
    named = best.join(items, best["_i"] == items["item_idx"])
    return named.select("user_id", "item_id", "score")


def score_pairs_multvae(
    model: VaeModel, histories: DataFrame, pairs: DataFrame, items: DataFrame
) -> DataFrame:
    """Logit of every (user, item) pair, 0 for unknown ones; one pass per user and chunk.

    A user's requested items travel as lists of at most the catalogue's length.
    """
    shared = histories.sparkSession.sparkContext.broadcast(model.weights)
    depth, n_items = model.depth, model.n_items
    wanted = (
        pairs.select("user_id", "item_id")
        .distinct()
        .join(items, "item_id")
        .groupBy("user_id")
        .agg(F.collect_set("item_idx").alias("_want"))
    )
    asked = histories.select("user_id", "item_idx", "weight").join(wanted, "user_id")
    user_type = histories.schema["user_id"].dataType.simpleString()

    def score(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for frame in batches:
            for at in range(0, len(frame), 512):
                part = frame.iloc[at : at + 512]
                x = densify(part["item_idx"], part["weight"], n_items)
                values = logits(x, shared.value, depth)
                rows, cols = _seen_cells(part["_want"])
                users = part["user_id"].to_numpy()[rows]
                yield pd.DataFrame({"user_id": users, "_i": cols, "_s": values[rows, cols]})

    scored = asked.mapInPandas(score, f"user_id {user_type}, _i long, _s double")
    named = scored.join(items, scored["_i"] == items["item_idx"]).select("user_id", "item_id", "_s")
    joined = pairs.join(named, ["user_id", "item_id"], "left")
    return joined.withColumn("score", F.coalesce("_s", F.lit(0.0))).drop("_s")
