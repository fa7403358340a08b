"""The two dataset profiles: node types, relations and their reverse names."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column
from pyspark.sql import functions as F

QA = "qa"
FORUM = "forum"
SELF_LOOP = "self_loop"

# Node types and (source, relation, destination) of each profile.
NODE_TYPES = {
    QA: ["user", "question", "answer"],
    FORUM: ["author", "post", "comment"],
}
BASE_EDGES = {
    QA: [
        ("user", "asks", "question"),
        ("user", "answers", "answer"),
        ("question", "has", "answer"),
        ("question", "accepted_answer", "answer"),
    ],
    FORUM: [
        ("author", "wrote_post", "post"),
        ("author", "wrote_comment", "comment"),
        ("post", "has_comment", "comment"),
    ],
}
TARGET = {QA: "user", FORUM: "author"}
LABEL = {QA: "influential", FORUM: "active"}
# End of fixed values.


def reverse_name(profile: str, relation: str) -> str:
    """Q&A reverses are prefixed (one has a short name), forum reverses are suffixed."""
    if profile == FORUM:
        return f"{relation}__reverse"
    return "rev_accepted" if relation == "accepted_answer" else f"rev_{relation}"


def edge_types(profile: str) -> list[tuple[str, str, str]]:
    """Every relation of the prepared graph: base, reversed, and the target's self loop."""
    target = TARGET[profile]
    reversed_edges = [(dst, reverse_name(profile, rel), src) for src, rel, dst in BASE_EDGES[profile]]
    return [*BASE_EDGES[profile], *reversed_edges, (target, SELF_LOOP, target)]


ALL_TYPES = [t for types in NODE_TYPES.values() for t in types]
INDEX_BITS = 56


def typed_id(node_type: str, idx: str) -> Column:
    """Type and index of a node in one number, which joins and sorts faster than the pair."""
    return F.lit(ALL_TYPES.index(node_type) << INDEX_BITS).bitwiseOR(F.col(idx))


def node_id(node_type: str, idx: str) -> Column:
    """``typed_id`` where the type is a column."""
    chain = F.when(F.lit(False), F.lit(0).cast("bigint"))
    for name in ALL_TYPES:
        chain = chain.when(F.col(node_type) == name, typed_id(name, idx))
    return chain.otherwise(F.raise_error(F.concat(F.lit("unknown node type: "), F.col(node_type))).cast("bigint"))


def type_of(node: str) -> Column:
    return F.get(F.array(*[F.lit(t) for t in ALL_TYPES]), F.shiftright(node, INDEX_BITS).cast("int"))


def index_of(node: str) -> Column:
    return F.col(node).bitwiseAND(F.lit((1 << INDEX_BITS) - 1))


@dataclass(frozen=True)
class Profile:
    """What a model needs to know about a dataset."""

    name: str

    @property
    def target(self) -> str:
        return TARGET[self.name]

    @property
    def label(self) -> str:
        return LABEL[self.name]

    @property
    def node_types(self) -> list[str]:
        return NODE_TYPES[self.name]

    @property
    def edge_types(self) -> list[tuple[str, str, str]]:
        return edge_types(self.name)

    def incoming(self, node_type: str) -> list[str]:
        return [rel for _, rel, dst in self.edge_types if dst == node_type]
