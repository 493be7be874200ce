"""Boolean query batches as a table: tokens, validity, canonical form, words.

Queries are ``queries(query_id, line)``. ``AND`` and ``OR`` apply strictly
from left to right, ``NOT`` to the word or group that follows it.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F

# A token is a parenthesis or a run of other non-delimiters.
TOKEN_PATTERN = r"[()]|[^ \t\n()]+"
KIND_OF_TOKEN = {"AND": "A", "OR": "O", "NOT": "N", "(": "L", ")": "R"}
WORD_KIND = "W"
WHOLE_QUERY = "^[WNL].*[WR]$|^W$"
OPERATOR_MISSING = "[WR][WNL]"
OPERAND_MISSING = "[AOL][AOR]|N[AONR]"

MASK_BITS = 62
MAX_TABLE_WORDS = 8


def tokens(line: Column) -> Column:
    return F.regexp_extract_all(line, F.lit(TOKEN_PATTERN), F.lit(0))


def kind_letters_sql(token_list: str) -> str:
    """One letter per token."""
    cases = "".join(f" WHEN '{text}' THEN '{code}'" for text, code in KIND_OF_TOKEN.items())
    return f"array_join(transform({token_list}, t -> CASE t{cases} ELSE '{WORD_KIND}' END), '')"


def query_words_sql(token_list: str) -> str:
    """Words with repeats, in order, negated ones included."""
    symbols = ", ".join(f"'{text}'" for text in KIND_OF_TOKEN)
    return f"filter({token_list}, t -> t NOT IN ({symbols}))"


def query_words(token_list: str) -> Column:
    return F.expr(query_words_sql(token_list))


def _balanced_sql(token_list: str) -> str:
    depth = "s.depth + CASE t WHEN '(' THEN 1 WHEN ')' THEN -1 ELSE 0 END"
    return (
        f"aggregate({token_list}, named_struct('depth', 0, 'lowest', 0), "
        f"(s, t) -> named_struct('depth', {depth}, 'lowest', least(s.lowest, {depth})), "
        "s -> s.depth = 0 AND s.lowest = 0)"
    )


def rejection_sql(token_list: str, kinds: str) -> str:
    """Why a query is invalid, null when it is valid."""
    return f"""CASE
        WHEN size({token_list}) = 0 THEN 'empty query'
        WHEN {kinds} RLIKE '{OPERATOR_MISSING}' THEN 'operator missing'
        WHEN {kinds} RLIKE '{OPERAND_MISSING}' OR NOT {kinds} RLIKE '{WHOLE_QUERY}'
            THEN 'operand missing'
        WHEN NOT {_balanced_sql(token_list)} THEN 'unbalanced parentheses' END"""


def fold_sql(
    items: str, value_type: str, symbol: str, operand: str, negate: str, combine: str
) -> str:
    """Value of a valid query by one left-to-right pass over its tokens.

    The accumulator is a stack of frames, one per open parenthesis, each with
    the value so far, the operator that waits and whether ``NOT`` waits. The
    pieces refer to the token as ``item``, to an operand's value as ``x`` and
    to the frame below it as ``top``.
    """

    def frame(value: str, op: str, negated: str) -> str:
        return (
            f"named_struct('value', cast({value} as {value_type}), "
            f"'op', cast({op} as string), 'negated', {negated})"
        )

    top = "get(stack, 0)"
    below = "slice(stack, 2, greatest(size(stack) - 1, 0))"
    replace_top = f"concat(array({{}}), {below})"
    # take: the operand x joins the frame on top of ``rest``.
    joined = frame(f"CASE WHEN top.op IS NULL THEN x ELSE {combine} END", "NULL", "false")
    placed = f"transform(array(CASE WHEN top.negated THEN {negate} ELSE x END), x -> {joined})"

    def take(rest: str, found: str) -> str:
        with_x = f"transform(array({found}), x -> get({placed}, 0))"
        with_top = f"transform(slice({rest}, 1, 1), top -> get({with_x}, 0))"
        return f"concat({with_top}, slice({rest}, 2, greatest(size({rest}) - 1, 0)))"

    start = f"array({frame('NULL', 'NULL', 'false')})"
    step = f"""CASE {symbol}
        WHEN '(' THEN concat({start}, stack)
        WHEN ')' THEN get(transform(array({below}), rest -> {take('rest', f'{top}.value')}), 0)
        WHEN 'NOT' THEN {replace_top.format(frame(f'{top}.value', f'{top}.op', 'true'))}
        WHEN 'AND' THEN {replace_top.format(frame(f'{top}.value', "'AND'", 'false'))}
        WHEN 'OR' THEN {replace_top.format(frame(f'{top}.value', "'OR'", 'false'))}
        ELSE {take('stack', operand)} END"""
    return f"get(aggregate({items}, {start}, (stack, item) -> {step}), 0).value"


def canonical_sql(token_list: str) -> str:
    """``(l AND r)``, ``(l OR r)``, ``NOT x`` or the word; the key of a batch."""
    return fold_sql(
        token_list,
        "string",
        symbol="item",
        operand="item",
        negate="concat('NOT ', x)",
        combine="concat('(', top.value, ' ', top.op, ' ', x, ')')",
    )


def truth_sql(program: str, masks: list[str]) -> str:
    """Truth of a query given which of its words matched.

    ``program`` is ``array<struct<symbol, word_no>>``; bit ``n % 62`` of mask
    ``n div 62`` says whether word ``n`` matched.
    """
    lanes = "".join(
        f" WHEN {lane} THEN (shiftright({mask}, item.word_no % {MASK_BITS}) & 1L) = 1L"
        for lane, mask in enumerate(masks)
    )
    return fold_sql(
        program,
        "boolean",
        symbol="item.symbol",
        operand=f"CASE item.word_no div {MASK_BITS}{lanes} ELSE false END",
        negate="NOT x",
        combine="CASE WHEN top.op = 'AND' THEN top.value AND x ELSE top.value OR x END",
    )


def query_table(queries: DataFrame) -> DataFrame:
    """``queries`` with ``tokens, kinds, reason, valid`` and, when valid, ``canon``."""
    return (
        queries.withColumn("tokens", tokens(F.col("line")))
        .withColumn("kinds", F.expr(kind_letters_sql("tokens")))
        .withColumn("reason", F.expr(rejection_sql("tokens", "kinds")))
        .selectExpr(
            "*",
            "reason IS NULL AS valid",
            f"if(reason IS NULL, {canonical_sql('tokens')}, NULL) AS canon",
        )
    )


def query_terms(queries: DataFrame) -> DataFrame:
    """``(query_id, word, repeats)`` of a query table."""
    return (
        queries.select("query_id", F.explode(query_words("tokens")).alias("word"))
        .groupBy("query_id", "word")
        .agg(F.count(F.lit(1)).alias("repeats"))
    )


def distinct_queries(table: DataFrame) -> DataFrame:
    """Equal canonical forms collapse to the entry with the smallest id.

    Invalid queries have no canonical form and are dropped.
    """
    return (
        table.filter("valid")
        .groupBy("canon")
        .agg(
            F.min("query_id").alias("query_id"),
            F.min_by("tokens", "query_id").alias("tokens"),
            F.count(F.lit(1)).alias("n_lines"),
        )
    )


def query_programs(table: DataFrame) -> DataFrame:
    """What evaluation needs per distinct valid query.

    ``words`` are the distinct words, numbered by position; ``program`` is the
    token list with word numbers; ``truth_table`` holds the truth for every
    set of matched words, for queries of at most ``MAX_TABLE_WORDS`` words
    (others are folded per document).
    """
    numbered = (
        "transform(tokens, t -> named_struct('symbol', t, "
        "'word_no', cast(array_position(words, t) - 1 as int)))"
    )
    every_mask = f"sequence(0L, shiftleft(1L, least(n_words, {MAX_TABLE_WORDS})) - 1L)"
    table_sql = f"transform({every_mask}, mask -> {truth_sql('program', ['mask'])})"
    return (
        distinct_queries(table)
        .withColumn("words", F.array_distinct(query_words("tokens")))
        .withColumn("program", F.expr(numbered))
        .withColumn("n_words", F.size("words"))
        .select(
            "query_id",
            "canon",
            "n_lines",
            "tokens",
            "words",
            "n_words",
            "program",
            F.expr(f"if(n_words <= {MAX_TABLE_WORDS}, {table_sql}, NULL)").alias("truth_table"),
            F.expr(truth_sql("program", ["0L"])).alias("true_without_match"),
        )
    )


def query_true(masks: list[str], most_words: int) -> Column:
    """Truth of the row's query, from its table where it has one."""
    from_table = f"get(truth_table, cast({masks[0]} as int))"
    if most_words <= MAX_TABLE_WORDS:
        return F.expr(from_table)
    return F.expr(f"if(truth_table IS NOT NULL, {from_table}, {truth_sql('program', masks)})")


def program_words(programs: DataFrame) -> DataFrame:
    """``(query_id, word, word_no, repeats)`` of query programs."""
    return programs.select(
        "query_id",
        query_words("tokens").alias("all_words"),
        F.posexplode("words").alias("word_no", "word"),
    ).select(
        "query_id",
        "word",
        "word_no",
        F.size(F.filter("all_words", lambda w: w == F.col("word"))).cast("long").alias("repeats"),
    )
