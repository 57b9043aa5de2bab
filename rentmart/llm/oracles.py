"""DuckDB SQL twins of the queries that SQL can express."""


def crc32(code_units: str) -> str:
    """The unsigned crc32 of a list of bytes: bit by bit, by the reversed polynomial."""
    step = "CASE WHEN x & 1 = 1 THEN xor(x >> 1, 3988292384) ELSE x >> 1 END"
    byte = f"list_reduce([xor(a, b), 0, 0, 0, 0, 0, 0, 0, 0]::BIGINT[], lambda x, y: {step})"
    return f"xor(list_reduce([4294967295]::BIGINT[] || {code_units}, lambda a, b: {byte}), 4294967295)"


#: UTF-8 bytes of a text of code points below U+0800
UTF8 = ("flatten(list_transform(string_split({0}, ''), lambda c: CASE WHEN unicode(c) < 128 THEN [unicode(c)::BIGINT] "
        "ELSE [(192 + (unicode(c) >> 6))::BIGINT, (128 + (unicode(c) & 63))::BIGINT] END))")

SQL = {
    "op8_mix_sources": r"""
WITH d AS (
  SELECT doc_id, source, len(regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+'))::BIGINT AS size,
         md5(coalesce(doc_id::VARCHAR, '') || ':mix') AS k
  FROM documents),
s AS (SELECT source, sum(size)::BIGINT AS source_size,
             [1, 2, 3][((row_number() OVER (ORDER BY source NULLS LAST) - 1) % 3 + 1)::INT] AS w
      FROM d GROUP BY source),
l AS (SELECT *, 3 * source_size AS cap, (3 * source_size)::DOUBLE / w AS level FROM s),
sh AS (SELECT *, (sum(source_size) OVER () - coalesce(sum(cap) OVER (ORDER BY level, source NULLS LAST
                    ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0))::DOUBLE
                 / sum(w) OVER (ORDER BY level, source NULLS LAST ROWS BETWEEN CURRENT ROW AND UNBOUNDED FOLLOWING) AS share
       FROM l),
f AS (SELECT arg_min(share, level) AS water FROM sh WHERE share < level),
t AS (SELECT source, source_size,
             CASE WHEN water IS NOT NULL AND level > water THEN w * water ELSE cap::DOUBLE END AS target
      FROM sh, f),
p AS (SELECT d.doc_id, d.size, t.source_size, t.target, floor(t.target)::BIGINT AS budget,
             coalesce(sum(d.size) OVER (PARTITION BY d.source ORDER BY k, size
                      ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0)::BIGINT AS before
      FROM d JOIN t ON d.source IS NOT DISTINCT FROM t.source),
e AS (SELECT *, CASE WHEN source_size > 0 THEN budget // source_size ELSE 0 END AS whole FROM p)
SELECT doc_id, size, source_size, target,
       (whole * size + least(size, greatest(budget - whole * source_size - before, 0)))::BIGINT AS taken
FROM e
""",
    "op6_line_dedup": r"""
WITH d AS (SELECT doc_id, string_split(coalesce(text, ''), chr(10)) AS lines FROM documents),
l AS (SELECT doc_id, unnest(lines) AS line, generate_subscripts(lines, 1) AS pos FROM d),
k AS (SELECT *, translate(trim(line, ' ' || chr(9) || chr(10) || chr(11) || chr(12) || chr(13)),
                          'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS key FROM l),
f AS (SELECT key, min(doc_id) AS first_doc FROM k WHERE length(key) >= 10 GROUP BY key),
j AS (SELECT k.*, (f.first_doc IS NOT NULL AND f.first_doc <> k.doc_id) AS dropped FROM k LEFT JOIN f ON k.key = f.key)
SELECT doc_id, count(*)::BIGINT AS n_lines, (count(*) FILTER (WHERE dropped))::BIGINT AS n_dropped,
       sha256(coalesce(string_agg(line, chr(10) ORDER BY pos) FILTER (WHERE NOT dropped), '')) AS kept_sha256
FROM j GROUP BY doc_id
""",
    "op12_spelling_variants": f"""
WITH RECURSIVE runs AS (
  SELECT coalesce(doc_id::VARCHAR, '') AS id,
         unnest(regexp_extract_all(translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[A-Za-z\\x{{00C0}}-\\x{{00FF}}]+')) AS run
  FROM documents),
counted AS (SELECT id, run, count(*) AS n FROM runs GROUP BY id, run),
hashed AS (SELECT run, n, {crc32(UTF8.format("id || ':' || run"))} AS h FROM counted),
cut AS (SELECT CASE WHEN h % 97 = 0 THEN left(run, (h % length(run))::INT) || substr(run, (h % length(run))::INT + 2) ELSE run END AS word, n
        FROM hashed),
words AS (SELECT word, sum(n)::BIGINT AS n FROM cut WHERE length(word) >= 5 GROUP BY word HAVING sum(n) >= 3),
less AS (SELECT word, n, i, left(word, i::INT - 1) || substr(word, i::INT + 1) AS short
         FROM (SELECT word, n, unnest(range(1, length(word) + 1)) AS i FROM words)),
near AS (SELECT a.word, b.word AS other, b.n AS other_n FROM less a JOIN less b
           ON a.short = b.short AND a.i = b.i AND a.word <> b.word
         UNION SELECT less.word, words.word, words.n FROM less JOIN words ON words.word = less.short
         UNION SELECT words.word, less.word, less.n FROM less JOIN words ON words.word = less.short),
best AS (SELECT word, count(*) AS n_near, (min({{'less': -other_n, 'other': other}})) AS b FROM near GROUP BY word),
formed AS (SELECT words.word, words.n, coalesce(n_near, 0)::BIGINT AS n_near,
                  CASE WHEN -b.less >= 2 * words.n THEN b.other END AS form, CASE WHEN -b.less >= 2 * words.n THEN -b.less END::BIGINT AS form_n
           FROM words LEFT JOIN best ON best.word = words.word),
steps AS (SELECT word, word AS at FROM formed
          UNION ALL SELECT steps.word, formed.form FROM steps JOIN formed ON formed.word = steps.at WHERE formed.form IS NOT NULL),
roots AS (SELECT steps.word, steps.at AS root FROM steps JOIN formed ON formed.word = steps.at WHERE formed.form IS NULL)
SELECT formed.word, form, root, n, n_near, form_n FROM formed JOIN roots ON roots.word = formed.word
""",
    "op13_prefix_trie": f"""
WITH t AS (
  SELECT conv_id, md5(length(coalesce(role, '')) || ':' || coalesce(role, '') || coalesce(text, '')) AS k,
         len(regexp_extract_all(coalesce(text, ''), '[^\\x20\\x09-\\x0D]+')) AS words, turn
  FROM conversations WHERE conv_id IS NOT NULL),
own AS (SELECT *, row_number() OVER (PARTITION BY conv_id ORDER BY turn NULLS FIRST, k) AS pos FROM t),
c AS (SELECT conv_id, count(*) AS n, conv_id - conv_id % 20 AS base,
             {crc32("list_transform(string_split(conv_id::VARCHAR, ''), lambda x: unicode(x)::BIGINT)")} % 4 AS h
      FROM own GROUP BY conv_id),
rebuilt AS (
  SELECT c.conv_id, own.pos AS depth, k, words FROM c JOIN own ON own.conv_id = c.base AND own.pos <= c.h
  UNION ALL
  SELECT c.conv_id, own.pos - c.h + least(c.h, coalesce(b.n, 0)), k, words
  FROM c JOIN own ON own.conv_id = c.conv_id AND own.pos > c.h LEFT JOIN c b ON b.conv_id = c.base),
m AS (SELECT conv_id, depth, words, md5(string_agg(k, '') OVER (PARTITION BY conv_id ORDER BY depth)) AS node FROM rebuilt
      UNION ALL SELECT conv_id, 0, 0, '' FROM c),
ends AS (SELECT conv_id, max(depth) AS length FROM m GROUP BY conv_id),
nodes AS (
  SELECT node, depth, min(m.conv_id) AS conv_id, count(*) AS n_convs, (count(*) - 1) * max(words) AS saved,
         sha256(coalesce(string_agg(m.conv_id::VARCHAR, ',' ORDER BY m.conv_id) FILTER (WHERE depth = length), '')) AS ends_sha256
  FROM m JOIN ends ON ends.conv_id = m.conv_id GROUP BY node, depth),
linked AS (SELECT nodes.*, up.node AS parent FROM nodes LEFT JOIN m up ON up.conv_id = nodes.conv_id AND up.depth = nodes.depth - 1),
children AS (SELECT parent, count(*) AS n FROM linked WHERE parent IS NOT NULL GROUP BY parent),
below AS (SELECT m.node, (count(*) FILTER (WHERE children.n IS NULL))::BIGINT AS n_leaves, sum(saved)::BIGINT AS saved_tokens
          FROM linked JOIN m ON m.conv_id = linked.conv_id AND m.depth <= linked.depth LEFT JOIN children ON children.parent = linked.node
          GROUP BY m.node)
SELECT linked.conv_id, linked.depth::BIGINT AS depth, up.conv_id AS parent_conv_id, linked.n_convs, coalesce(children.n, 0)::BIGINT AS n_children,
       n_leaves, saved_tokens, linked.ends_sha256
FROM linked JOIN below ON below.node = linked.node LEFT JOIN children ON children.parent = linked.node LEFT JOIN nodes up ON up.node = linked.parent
""",
}
