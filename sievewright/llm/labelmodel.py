"""A generative model of noisy voters, fitted by expectation-maximisation.

Each voter says 1 (yes), -1 (no) or 0 (abstains).  A record's votes are a pattern of a few
characters, so the data enter the fit as counts of patterns: they are counted over all records
where those lie, at most 3 ** voters rows come to the driver, and the posterior of each pattern
goes goes back as a table of the same size.

Two models share that frame.  :func:`fit` takes voters as independent given the class, with
abstentions that say nothing.  :func:`fit_correlated` estimates which voters depend on each other
beyond the class and fits their joint distribution along the strongest dependencies.
"""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

CODES = {"+": 1, "-": -1, "0": 0}
MAX_VOTERS = 10


@dataclass
class LabelModel:
    """P(vote | class) of each voter, voter x class x (no, yes), given that it votes; class prior.

    An abstention says nothing of the class.
    """

    table: np.ndarray
    prior: float

    def posterior(self, pattern: str) -> float:
        logs = np.log([1 - self.prior, self.prior])
        for j, c in enumerate(pattern):
            if c != "0":
                logs = logs + np.log(self.table[j, :, int(c == "+")])
        p = np.exp(logs - logs.max())
        return float(p[1] / p.sum())


def fit(counts: dict[str, int], voters: int, prior: float = 0.05, rounds: int = 200, strength: float = 0.2, groups: list[int] | None = None) -> LabelModel:
    """EM from the belief that voters are right nine times out of ten.

    Pseudo-records of that belief, ``strength`` of the number of records, hold each voter to its
    meaning, so that it can't flip on a table where a class is missing.  Voters of the same
    number in ``groups`` see the same evidence and are correlated: each then counts with the root
    of its group's size less.
    """
    if voters > MAX_VOTERS:
        raise ValueError(f"more than {MAX_VOTERS} voters")
    patterns = sorted(counts)
    n = np.array([counts[p] for p in patterns], float)
    votes = np.array([[CODES[c] for c in p] for p in patterns], int).reshape(len(patterns), voters)
    belief = np.array([[0.9, 0.1], [0.1, 0.9]])  # class no, class yes
    table = np.repeat(belief[None], voters, axis=0)
    damp = np.ones(voters)
    if groups:
        damp = np.array([1 / np.sqrt(groups.count(g)) for g in groups])
    total = n.sum()
    held = max(20.0, strength * total) * prior
    pi = prior
    # The first guess is the majority of the votes.
    lead = np.clip(votes.sum(axis=1), -3, 3) * 2.0
    first = 1 / (1 + np.exp(-lead))
    q = np.stack((1 - first, first), axis=1)
    for step in range(rounds):
        if step:
            logs = np.repeat(np.log([1 - pi, pi])[None], len(patterns), axis=0)
            for j in range(voters):
                said = votes[:, j] != 0
                logs[said] += damp[j] * np.log(table[j][:, (votes[said, j] > 0).astype(int)]).T
            q = np.exp(logs - logs.max(axis=1, keepdims=True))
            q /= q.sum(axis=1, keepdims=True)
        new = np.empty_like(table)
        for j in range(voters):
            for v in (0, 1):
                new[j, :, v] = (n[:, None] * q * (votes[:, j] == 2 * v - 1)[:, None]).sum(axis=0) + held * belief[:, v]
        new /= new.sum(axis=2, keepdims=True)
        pi = float(np.clip(((n * q[:, 1]).sum() + held * prior) / (total + held), 1e-6, 0.9))
        done = np.abs(new - table).max() < 1e-7
        table = new
        if done:
            break
    return LabelModel(table ** damp[:, None, None], pi)


def posteriors(df: DataFrame, column: str, voters: int, groups: list[int] | None = None) -> dict[str, float]:
    """Posterior of each pattern in a column of vote patterns, fitted on the counts of all rows."""
    counts = {r[column]: r["n"] for r in df.where(F.col(column).isNotNull()).groupBy(column).agg(F.count(F.lit(1)).alias("n")).collect()}
    model = fit(counts, voters, groups=groups) if counts else None
    return {p: model.posterior(p) for p in counts} if model else {}


@dataclass
class CorrelatedModel:
    """Class prior, accuracies and dependencies of voters, and the posterior of each pattern seen.

    ``rates``: of each voter P(+ | no), P(+ | yes).  ``edges``: pairs of voters that depend on each
    other beyond the class, with the share of the weaker one's entropy that the other explains.
    """

    prior: float
    rates: list[tuple[float, float]]
    edges: list[tuple[int, int, float]]
    posteriors: dict[str, float]


#: First belief that a record with a voter's + is of the class, and the share of the weight that the
#: first beliefs keep in every step.
TRUST, HOLD = 0.8, 0.1


def fit_correlated(counts: dict[str, int], trust: list[float], hold: float = HOLD, dependence: float = 0.02, rounds: int = 200, smooth: float = 1.0) -> CorrelatedModel:
    """EM for a latent class with a forest of dependencies between voters.

    ``counts``: of patterns of + and -, of all records, those without a vote too.  ``trust``: the first
    belief that a voter's + is right, 0 for a voter that speaks against.  Nothing is assumed about how
    frequent the class is or how often a voter speaks, and ``hold`` keeps the class to its meaning: EM
    maximises over its own beliefs and that share of the first ones.  A voter for the class never
    speaks less often within it than without, one against it never more often.

    EM first estimates prior and accuracies as if voters were independent; what dependence is left
    within the classes is measured by the conditional mutual information of each pair, the strongest
    pairs above ``dependence`` make a forest (Chow and Liu), and EM goes on with P(vote | class, parent's vote).
    """
    voters = len(trust)
    patterns = sorted(p for p, n in counts.items() if n > 0)
    if not patterns or voters == 0:
        return CorrelatedModel(0.0, [(0.0, 0.0)] * voters, [], {})
    against = [t == 0 for t in trust]
    n = np.array([counts[p] for p in patterns], float)
    v = np.array([[int(c == "+") for c in p] for p in patterns], int).reshape(len(patterns), voters)
    total = n.sum()

    def belief(groups: list[int]) -> np.ndarray:
        """Before any fit: voters that depend on each other count once; without a vote for it, no."""
        doubt = np.ones((len(patterns), voters))
        for j in range(voters):
            doubt[:, groups[j]] = np.minimum(doubt[:, groups[j]], np.where(v[:, j] == 1, 1 - trust[j], 1.0))
        out = 1 - doubt.prod(axis=1)
        for j in range(voters):
            if against[j]:
                out = np.where(v[:, j] == 1, out * (1 - TRUST), out)
        return out

    first = q = belief(list(range(voters)))
    marginal = (n @ v) / total

    def joint(q: np.ndarray, parents: list[int]) -> tuple[float, list[np.ndarray]]:
        """Prior and P(vote | class, parent's vote) of each voter."""
        q = (1 - hold) * q + hold * first
        weight = n[:, None] * np.stack((1 - q, q), axis=1)
        tables = []
        for j, p in enumerate(parents):
            table = np.empty((2, 2, 2))  # class, parent's vote, vote
            for c in (0, 1):
                own = (weight[:, c] @ v[:, j] + smooth * marginal[j]) / (weight[:, c].sum() + smooth)
                for u in (0, 1):
                    rows = np.ones(len(n), bool) if p < 0 else v[:, p] == u
                    plus = weight[rows, c] @ v[rows, j]
                    # With little to see of a parent's vote, the voter's own rate holds.
                    rate = (plus + 5 * smooth * own) / (weight[rows, c].sum() + 5 * smooth)
                    table[c, u] = 1 - rate, rate
            for u in (0, 1):
                no, yes = table[0, u, 1], table[1, u, 1]
                yes = min(yes, no) if against[j] else max(yes, no)
                table[1, u] = 1 - yes, yes
            tables.append(np.clip(table, 1e-9, 1))
        return float(np.clip((n @ q) / total, 1e-9, 1 - 1e-9)), tables

    def posterior(prior: float, tables: list[np.ndarray], parents: list[int]) -> np.ndarray:
        logs = np.repeat(np.log([1 - prior, prior])[None], len(patterns), axis=0)
        for j, p in enumerate(parents):
            logs += np.log(tables[j][:, v[:, p] if p >= 0 else np.zeros(len(n), int), v[:, j]]).T
        q = np.exp(logs - logs.max(axis=1, keepdims=True))
        return q[:, 1] / q.sum(axis=1)

    def settle(q: np.ndarray, parents: list[int]) -> np.ndarray:
        for _ in range(rounds):
            new = posterior(*joint(q, parents), parents)
            done = np.abs(new - q).max() < 1e-7
            q = new
            if done:
                break
        return q

    alone = [-1] * voters
    q = settle(q, alone)
    found = []
    for i in range(voters):
        for j in range(i + 1, voters):
            share = 0.0
            for weight in (n * (1 - q), n * q):
                size = weight.sum()
                if size < 50:
                    continue
                cell = np.array([[weight[(v[:, i] == a) & (v[:, j] == b)].sum() for b in (0, 1)] for a in (0, 1)]) / size
                left, right = cell.sum(axis=1), cell.sum(axis=0)
                with np.errstate(divide="ignore", invalid="ignore"):
                    mutual = np.nansum(cell * np.log(cell / np.outer(left, right)))
                    entropy = min(-np.nansum(x * np.log(x)) for x in (left, right))
                if entropy > 1e-9 and 2 * size * mutual > 15:  # beyond chance
                    share = max(share, mutual / entropy)
            if share > dependence:
                found.append((share, i, j))
    # The strongest dependencies that make no ring, each tree hung up at its first voter.
    tree = list(range(voters))

    def root(x: int) -> int:
        while tree[x] != x:
            x = tree[x]
        return x

    near: dict[int, list[int]] = {j: [] for j in range(voters)}
    edges = []
    for share, i, j in sorted(found, reverse=True):
        if root(i) != root(j):
            tree[root(j)] = root(i)
            near[i].append(j)
            near[j].append(i)
            edges.append((i, j, float(share)))
    parents, seen = [-1] * voters, set()
    for start in range(voters):
        queue = [] if start in seen else [start]
        seen.update(queue)
        while queue:
            x = queue.pop()
            for y in near[x]:
                if y not in seen:
                    seen.add(y)
                    parents[y] = x
                    queue.append(y)
    if edges:
        first = belief([root(j) for j in range(voters)])
        q = settle(first, parents)
    prior, tables = joint(q, alone)
    return CorrelatedModel(prior, [(float(t[0, 0, 1]), float(t[1, 0, 1])) for t in tables], edges, dict(zip(patterns, map(float, q))))
