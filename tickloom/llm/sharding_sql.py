"""SQL that gives the rows of the sharding query by another route.

It walks through the whole rectangle of cells once, lists where each cell leads, and
follows the chains of cells outside by recursion.
"""

from tickloom.llm.sharding import _PRIME, ROUNDS, round_keys


def _scramble(x: str, key: int) -> str:
    first = f"((({x}) + {key}) % {_PRIME} * 1540483477 % {_PRIME})"
    second = f"(xor({first}, {first} >> 15) * 1103515245 % {_PRIME})"
    return f"xor({second}, {second} >> 13)"


def _crc_words(low: str) -> str:
    """What the CRC-32 polynomial makes of a low byte: the sum of what each of its bits gives."""
    given = []
    for bit in range(8):
        word = 1 << bit
        for _ in range(8):
            word = word >> 1 ^ (0xEDB88320 if word & 1 else 0)
        given.append(f"((({low}) >> {bit}) & 1) * {word}")
    return "xor(" * 7 + given[0] + "".join(f", {x})" for x in given[1:])


def shard_sql(shards: int = 40, seed: int = 2024, grains: int = 4096) -> str:
    keys = round_keys(seed)
    stages = ["cells0 AS (SELECT x, x // rgt AS a, x % rgt AS b, lft, rgt, n FROM sides, range(lft * rgt) AS t(x))"]
    for r in range(ROUNDS):
        a, b = (f"(a + {_scramble('b', keys[r])}) % lft", "b") if r % 2 == 0 else ("a", f"(b + {_scramble('a', keys[r])}) % rgt")
        stages.append(f"cells{r + 1} AS (SELECT x, {a} AS a, {b} AS b, lft, rgt, n FROM cells{r})")
    mixed = "17"
    for value in ("coalesce(doc_id, -1)", "text_crc32", "size"):
        mixed = f"((xor({mixed}, (({value}) % {_PRIME} + {_PRIME}) % {_PRIME}) % {_PRIME} * 1540483477 + 97) % {_PRIME})"
    return f"""
    WITH RECURSIVE bytes AS (
        SELECT doc_id, encode(coalesce(text, '')) AS content FROM documents
    ), sized AS (
        SELECT doc_id, octet_length(content) + 16 AS size, xor(4294967295::BIGINT, list_reduce(
            list_prepend(4294967295::BIGINT, list_transform(regexp_extract_all(hex(content), '..'), lambda h: ('0x' || h)::BIGINT)),
            lambda c, v: xor({_crc_words('xor(c, v) & 255')}, c >> 8))) AS text_crc32
        FROM bytes
    ), counted AS (SELECT count(*) AS n FROM documents
    ), edge AS (SELECT n, floor(sqrt(greatest(n - 1, 0)))::BIGINT + 1 AS lft FROM counted
    ), sides AS (SELECT n, lft, greatest(1, (n + lft - 1) // lft) AS rgt FROM edge
    ), {', '.join(stages)},
    moves AS (SELECT x, a * rgt + b AS y, n FROM cells{ROUNDS}),
    walk AS (
        SELECT x, y FROM moves WHERE x < n
        UNION ALL
        SELECT w.x, m.y FROM walk AS w JOIN moves AS m ON w.y = m.x WHERE w.y >= m.n
    ),
    places AS (SELECT w.x, w.y FROM walk AS w, counted WHERE w.y < n),
    numbered AS (
        SELECT *, row_number() OVER (ORDER BY ({mixed} >> 7) % {grains}, doc_id NULLS FIRST, text_crc32, size) - 1 AS number FROM sized
    )
    SELECT doc_id, size, text_crc32, 'rows' AS law, (y % {shards})::INTEGER AS shard, y // {shards} AS slot, NULL::INTEGER AS grown_shard
    FROM numbered JOIN places ON number = x"""
