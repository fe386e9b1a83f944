"""Which partition folders a statement over `commits` can need, by a look at its plan.

Rows lie in folders by the first letter of their author. A condition on `author`
does not name that letter, so Spark alone opens every folder. Here a statement is
planned once, without running it, and the plan is asked what it demands of each
scan of the table: `author = …`, `author IN (…)`, or a join on `author` with a side
small enough to be broadcast, whose letters are then looked up.
"""

from __future__ import annotations

from dataclasses import dataclass, field

from py4j.java_gateway import JavaObject
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

# Both mark a scan of the commits table.
KEY, AUTHOR = "author_first_char", "author"
# Nodes that leave rows and their columns' identities as they are.
_PASSING = {"Filter", "Project", "SubqueryAlias", "View"}
# Sides of a join that keep only rows with a partner.
_PRUNED_SIDES = {"Inner": (0, 1), "LeftSemi": (0, 1), "LeftOuter": (1,), "RightOuter": (0,), "LeftAnti": (1,)}


def _kind(node: JavaObject) -> str:
    return node.getClass().getSimpleName().rstrip("$")


def _items(seq: JavaObject) -> list:
    return [seq.apply(i) for i in range(seq.size())]


def _conjuncts(condition: JavaObject) -> list[JavaObject]:
    if _kind(condition) == "And":
        return _conjuncts(condition.left()) + _conjuncts(condition.right())
    return [condition]


def _id(expression: JavaObject) -> int | None:
    return expression.exprId().id() if _kind(expression) == "AttributeReference" else None


def first_letter(author: str) -> str:
    return author[:1].lower()


@dataclass
class Scan:
    """One scan of the table: the author column's id, and what is known of its letters.

    `exact` says that the letters come from equalities with constants only.
    """

    author: int
    letters: set[str] | None = None
    exact: bool = True
    uses: list = field(default_factory=list)

    def narrow(self, letters: set[str], exact: bool) -> None:
        self.exact = exact and (self.exact or self.letters is None)
        self.letters = letters if self.letters is None else self.letters & letters


def _constants(condition: JavaObject, author: int) -> tuple[set[str], bool] | None:
    """Letters that a condition allows, and whether it is an equality; None if it says nothing."""
    kind = _kind(condition)
    if kind in ("EqualTo", "EqualNullSafe"):
        for column, value in ((condition.left(), condition.right()), (condition.right(), condition.left())):
            if _id(column) == author and _kind(value) == "Literal" and value.value() is not None:
                return {first_letter(value.value().toString())}, True
    if kind == "In" and _id(condition.value()) == author:
        values = _items(condition.list())
        if all(_kind(v) == "Literal" for v in values):
            return {first_letter(v.value().toString()) for v in values if v.value() is not None}, False
    if kind == "InSet" and _id(condition.child()) == author:
        found = _items(condition.hset().toSeq())
        return {first_letter(v.toString()) for v in found if v is not None}, False
    return None


def _is_commits(node: JavaObject) -> bool:
    return _kind(node) == "LogicalRelation" and {KEY, AUTHOR, "commit_hash"} <= {a.name() for a in _items(node.output())}


class _Look:
    """A walk over one optimised plan."""

    def __init__(self, spark: SparkSession):
        self.spark = spark
        self.scans: list[Scan] = []
        limit = int(spark._jsparkSession.sessionState().conf().autoBroadcastJoinThreshold())
        self.most_bytes = max(0, limit)

    def letters_of(self, side: JavaObject, column: JavaObject) -> set[str] | None:
        """First letters of a join's other side, if it is small and always the same."""
        if side.isStreaming() or not side.deterministic() or int(str(side.stats().sizeInBytes())) > self.most_bytes:
            return None
        rows = self.spark._jvm.org.apache.spark.sql.classic.Dataset.ofRows(self.spark._jsparkSession, side)
        at = next(i for i, a in enumerate(_items(side.output())) if a.exprId().id() == column.exprId().id())
        plain = DataFrame(rows, self.spark).toDF(*(f"c{i}" for i in range(side.output().size())))
        found = plain.select(F.lower(F.substring(f"c{at}", 1, 1)).alias("letter")).distinct().collect()
        return {row.letter for row in found if row.letter is not None}

    def joined(self, join: JavaObject, scans: list[list[Scan]]) -> None:
        """Conditions of a join on authors of scans that reach it row by row."""
        if join.condition().isEmpty():
            return
        for condition in _conjuncts(join.condition().get()):
            if _kind(condition) != "EqualTo":
                continue
            for own, other in ((condition.left(), condition.right()), (condition.right(), condition.left())):
                for side in _PRUNED_SIDES.get(_kind(join.joinType()), ()):
                    there = join.right() if side == 0 else join.left()
                    for scan in scans[side]:
                        ids = {a.exprId().id() for a in _items(there.output())}
                        if _id(own) == scan.author and _id(other) in ids:
                            scan.uses.append((there, other))

    def visit(self, node: JavaObject, conditions: list[JavaObject]) -> list[Scan]:
        """Look below `node`; returns the scans whose rows reach it unchanged."""
        kind = _kind(node)
        if _is_commits(node):
            author = next(a.exprId().id() for a in _items(node.output()) if a.name() == AUTHOR)
            scan = Scan(author)
            for condition in conditions:
                allowed = _constants(condition, author)
                if allowed:
                    scan.narrow(*allowed)
            self.scans.append(scan)
            return [scan]
        if kind == "Filter":
            conditions = conditions + _conjuncts(node.condition())
        below = [self.visit(child, conditions if kind in _PASSING else []) for child in _items(node.children())]
        for inner in _items(node.subqueries()):
            self.visit(inner, [])
        if kind == "Join":
            self.joined(node, below)
        return below[0] if kind in _PASSING and below else []

    def finish(self) -> None:
        for scan in self.scans:
            # A lookup is a job, so only where no constant says enough.
            for side, column in scan.uses if scan.letters is None else ():
                letters = self.letters_of(side, column)
                if letters is not None:
                    scan.narrow(letters, False)
                    break


def scans_of(spark: SparkSession, text: str) -> list[Scan]:
    """The scans of the table in a statement; none if it is a command, which is not run."""
    state = spark._jsparkSession.sessionState()
    parsed = state.sqlParser().parsePlan(text)
    skip = spark._jvm.org.apache.spark.sql.execution.CommandExecutionMode.SKIP()
    planned = state.executePlan(parsed, skip)
    is_command = spark._jvm.java.lang.Class.forName("org.apache.spark.sql.catalyst.plans.logical.Command").isInstance
    if is_command(planned.analyzed()):
        return []
    look = _Look(spark)
    look.visit(planned.optimizedPlan(), [])
    look.finish()
    return look.scans


def pruned(spark: SparkSession, commits: DataFrame, text: str) -> DataFrame:
    """`commits`, with the folders left out that the statement, put to it as a view, cannot need.

    The statement's result over the returned rows is that over all rows.
    """
    scans = scans_of(spark, text)
    key = F.coalesce(F.col(KEY), F.lit(""))
    if scans and all(s.letters is not None for s in scans) and (len(scans) == 1 or not all(s.exact for s in scans)):
        return commits.filter(key.isin(sorted(set().union(*(s.letters for s in scans)))))
    if any(s.letters is not None and s.exact for s in scans):
        # Always true; with it Spark derives the letter from each scan's own constant.
        return commits.filter(key == F.coalesce(F.lower(F.substring(AUTHOR, 1, 1)), F.lit("")))
    return commits
