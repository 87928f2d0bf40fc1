"""Chat formatting: reply trees, their root-to-leaf paths by iterative self-joins, one conversation per chosen path.

Everything is DataFrame and SQL functions. Joins double the distance that they look up, so a tree of depth d takes
about log2(d) of them, and what is kept grows with the messages, not with the square of the depth.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from subtally.llm.common import stored

# The control strings of the template. A turn is [INST]role[/INST]text</s>, <s> opens the conversation.
BEGIN, END, OPEN, CLOSE = "<s>", "</s>", "[INST]", "[/INST]"
ESCAPED = r"([\\<\[])\\"


def quoted(text: str) -> str:
    """A SQL literal."""
    return "'" + text.replace("\\", "\\\\").replace("'", "\\'") + "'"


def escaped(text: str) -> str:
    """SQL that breaks every control string inside a text by a backslash after its first character, and doubles backslashes."""
    found = f"replace({text}, {quoted(chr(92))}, {quoted(chr(92) * 2)})"
    for mark in (BEGIN, END, OPEN, CLOSE):
        found = f"replace({found}, {quoted(mark)}, {quoted(mark[0] + chr(92) + mark[1:])})"
    return found


def unescaped(text: str) -> str:
    """SQL that undoes ``escaped``: a backslash after a backslash, < or [ goes, read from the left."""
    return f"regexp_replace({text}, {quoted(ESCAPED)}, '$1')"


def as_replies(turns: DataFrame, tree: str = "conv_id", order: str = "turn") -> DataFrame:
    """(tree, node, parent, role, text, score): rows that only have an order as trees in which each row replies to the one before.

    Equal places in the order are told apart by role and text, nulls last; repeated rows are turns of their own. Every
    turn scores one. A conversation is one row of the result in the end, so its turns may meet in one task here.
    """
    by_turn = [F.col(c).asc_nulls_last() for c in (order, "role", "text")]
    place = F.row_number().over(Window.partitionBy(F.col(tree)).orderBy(*by_turn)).cast("bigint")
    rows = turns.select(F.col(tree).alias("tree"), place.alias("node"), "role", "text")
    return rows.selectExpr("tree", "node", "nullif(node - 1, 0) AS parent", "role", "text", "1D AS score")


def messages(replies: DataFrame) -> DataFrame:
    """One row for each (tree, node): without an id a message can't be placed and goes, repeated ids keep their least row."""
    own = replies.selectExpr(
        "tree", "node", "parent", "coalesce(role, '') AS role", "coalesce(text, '') AS text", "coalesce(nanvl(score, 0D), 0D) AS score"
    )
    least = F.min(F.struct("parent", "role", "text", "score")).alias("_m")
    return own.filter("node IS NOT NULL").groupBy("tree", "node").agg(least).select("tree", "node", "_m.*")


def jumps(nodes: DataFrame) -> tuple[list[DataFrame], DataFrame]:
    """The tables of jumps, and (tree, node, steps, total) of every node that a root is above: messages on the way down to it
    and their scores' sum.

    Table j holds (tree, node, up, steps, total) where there is an ancestor 2**j steps up. Only its rows go on into the
    next round. A parent that isn't in the tree counts as none. Nodes on a cycle, and below one, never reach a root; the
    size of the largest tree bounds the number of rounds for them.
    """
    same = F.col("tree").eqNullSafe(F.col("_tree")) & (F.col("up") == F.col("_node"))
    known = nodes.selectExpr("tree AS _tree", "node AS _node")
    first = nodes.selectExpr("tree", "node", "parent AS up", "1L AS steps", "score AS total").join(known, same, "left")
    step = stored(first.selectExpr("tree", "node", "_node AS up", "steps", "total"), "replies")
    largest = nodes.groupBy("tree").count().agg(F.max("count")).first()[0] or 0
    tables, done = [], step.filter("up IS NULL")
    for _ in range(largest.bit_length()):
        going = step.filter("up IS NOT NULL")
        if going.isEmpty():
            break
        tables.append(going)
        further = going.unionByName(done).selectExpr("tree AS _tree", "node AS _node", "up AS _up", "steps AS _steps", "total AS _total")
        doubled = going.join(further, same)
        step = stored(doubled.selectExpr("tree", "node", "_up AS up", "steps + _steps AS steps", "total + _total AS total"), "replies")
        done = done.unionByName(step.filter("up IS NULL"))
    return tables, done.drop("up")


def ranked_branches(nodes: DataFrame, far: DataFrame, keep: int) -> DataFrame:
    """(tree, branch, node): the leaves whose paths score highest, ``branch`` from 1; equal scores by the smaller leaf.

    Spark cuts each task's rows at ``keep`` per tree before it brings a tree together.
    """
    replied = nodes.filter("parent IS NOT NULL").selectExpr("tree AS _tree", "parent AS _node").distinct()
    leaves = far.join(replied, far["tree"].eqNullSafe(F.col("_tree")) & (far["node"] == F.col("_node")), "left_anti")
    order = Window.partitionBy("tree").orderBy(F.col("total").desc(), F.col("node"))
    return leaves.select("tree", "node", F.row_number().over(order).alias("branch")).filter(F.col("branch") <= keep)


def paths(replies: DataFrame, keep: int = 1) -> DataFrame:
    """(tree, branch, place, role, text): the messages of the ``keep`` best root-to-leaf paths of every tree, place from 1.

    ``replies`` has (tree, node, parent, role, text, score), other columns are left out. Null role or text counts as
    empty, a null or NaN score as zero, a null tree is a tree like any other. A message whose parent isn't there is a
    root; messages on a cycle or below one are on no path. A message may be on several paths.
    """
    nodes = stored(messages(replies), "messages")
    tables, far = jumps(nodes)
    on_path = ranked_branches(nodes, far, keep)
    for table in reversed(tables):
        up = table.selectExpr("tree AS _tree", "node AS _node", "up")
        same = F.col("tree").eqNullSafe(F.col("_tree")) & (F.col("node") == F.col("_node"))
        above = on_path.join(up, same).selectExpr("tree", "up AS node", "branch")
        on_path = stored(on_path.select("tree", "node", "branch").unionByName(above), "paths")
    own = nodes.selectExpr("tree AS _tree", "node AS _node", "role", "text")
    place = far.selectExpr("tree AS _tree", "node AS _node", "steps AS place")
    same = on_path["tree"].eqNullSafe(F.col("_tree")) & (on_path["node"] == F.col("_node"))
    placed = on_path.join(place, same).drop("_tree", "_node")
    return placed.join(own, placed["tree"].eqNullSafe(own["_tree"]) & (placed["node"] == own["_node"])).select(
        "tree", "branch", "place", "role", "text"
    )


def formatted(messages_of: DataFrame, trained_role: str = "assistant") -> DataFrame:
    """(tree, branch, formatted, loss): one conversation per path; ``loss`` has the (start, end) of the escaped texts of the
    trained role, in code points. A conversation has to fit a row.
    """
    pieces = messages_of.selectExpr(
        "tree",
        "branch",
        "place",
        f"concat('{OPEN}', {escaped('role')}, '{CLOSE}') AS head",
        f"concat({escaped('text')}, '{END}') AS body",
        f"role = {quoted(trained_role)} AS trained",
    )
    size = "sum(length(head) + length(body)) OVER (PARTITION BY tree, branch ORDER BY place)"
    stops = pieces.selectExpr("tree", "branch", "place", "concat(head, body) AS turn", "length(body) AS n", "trained", f"{size} AS stop")
    turns = F.array_sort(F.collect_list(F.struct("place", "turn", "n", "trained", "stop"))).alias("turns")
    span = f"struct({len(BEGIN)} + t.stop - t.n AS start, {len(BEGIN) - len(END)} + t.stop AS end)"
    return stops.groupBy("tree", "branch").agg(turns).selectExpr(
        "tree",
        "branch",
        f"concat('{BEGIN}', array_join(transform(turns, t -> t.turn), '')) AS formatted",
        f"transform(filter(turns, t -> t.trained), t -> {span}) AS loss",
    )


def format_replies(replies: DataFrame, keep: int = 1, trained_role: str = "assistant") -> DataFrame:
    """(tree, branch, formatted, loss) of the ``keep`` best branches of every reply tree; see ``paths`` and ``formatted``."""
    return formatted(paths(replies, keep), trained_role)


def read_back(conversations: DataFrame) -> DataFrame:
    """Adds ``turns``, an array of (role, text), and ``loss_text``, both taken from the formatted text alone and its spans."""
    turn = f"split(x, {quoted(r'\[/INST\]')})"
    parts = f"split(substring(formatted, {1 + len(BEGIN)}), '{END}')"  # the last part, after the last end mark, is empty
    role = unescaped(f"substring(get({turn}, 0), {1 + len(OPEN)})")
    marked = unescaped("substring(formatted, cast(s.start AS int) + 1, cast(s.end - s.start AS int))")
    return conversations.selectExpr("*", f"{parts} AS _parts").selectExpr(
        "* EXCEPT (_parts)",
        f"transform(slice(_parts, 1, size(_parts) - 1), x -> struct({role} AS role, {unescaped(f'get({turn}, 1)')} AS text)) AS turns",
        f"array_join(transform(loss, s -> {marked}), '') AS loss_text",
    )


def digest_columns(read: DataFrame) -> list[Column]:
    turns = "array_join(transform(turns, t -> concat(t.role, '\\n', t.text, '\\n')), '')"
    columns = {
        "n_turns": "cast(size(turns) AS bigint)",
        "turns_sha256": f"sha2({turns}, 256)",
        "loss_chars": "cast(length(loss_text) AS bigint)",
        "loss_sha256": "sha2(loss_text, 256)",
        "formatted_chars": "cast(length(formatted) AS bigint)",
    }
    return [F.expr(sql).alias(name) for name, sql in columns.items()]
