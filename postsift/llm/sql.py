"""SQL for DuckDB that gives the rows of queries, where SQL can express them."""

SQL: dict[str, str] = {}

SQL["op4_warc"] = """
WITH payloads AS (
    SELECT page_id, coalesce(html, '') AS payload FROM pages
), hashed AS (
    SELECT page_id, strlen(payload) AS payload_bytes, sha1(payload) AS hex FROM payloads
), named AS (
    SELECT page_id, payload_bytes, array_to_string(list_transform(range(8), lambda i: array_to_string(list_transform([15, 10, 5, 0],
               lambda s: substr('ABCDEFGHIJKLMNOPQRSTUVWXYZ234567', 1 + ((('0x' || substr(hex, 1 + 5 * i, 5))::BIGINT >> s) & 31)::INT, 1)), '')), '') AS payload_digest
    FROM hashed
), grouped AS (
    SELECT *, max(page_id) OVER (PARTITION BY payload_digest, payload_bytes) AS original FROM named
)
SELECT page_id, payload_bytes, payload_digest,
       CASE WHEN original IS NULL OR page_id IS NOT DISTINCT FROM original THEN 'response' ELSE 'revisit' END AS record_type,
       CASE WHEN original IS NULL OR page_id IS NOT DISTINCT FROM original THEN NULL ELSE original END AS refers_to
FROM grouped
"""

SQL["op6_mixing"] = r"""
WITH sized AS (
    SELECT doc_id, source, len(regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+')) AS size FROM documents
), by_source AS (
    SELECT source, sum(size)::BIGINT AS source_size, count(*) AS n FROM sized GROUP BY source
), weighted AS (
    SELECT *, 3 * source_size AS bound, 1 + (row_number() OVER (ORDER BY source NULLS LAST) - 1) % 3 AS weight FROM by_source
), leveled AS (
    SELECT *, (sum(source_size) OVER () - coalesce(sum(bound) OVER (ORDER BY bound / weight, source NULLS LAST ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0))
              / sum(weight) OVER (ORDER BY bound / weight, source NULLS LAST ROWS BETWEEN CURRENT ROW AND UNBOUNDED FOLLOWING) AS level
    FROM weighted
), final AS (
    SELECT *, max(CASE WHEN bound / weight > level THEN level END) OVER () AS water FROM leveled
), targets AS (
    SELECT source, source_size, n,
           least(CASE WHEN bound / weight <= level OR water IS NULL THEN bound::DOUBLE ELSE water * weight END, bound::DOUBLE) AS target
    FROM final
), wanted AS (
    SELECT s.*, t.source_size, t.n, t.target, CASE WHEN source_size > 0 THEN target / source_size ELSE 0.0 END AS wanted
    FROM sized s JOIN targets t ON s.source IS NOT DISTINCT FROM t.source
), drawn AS (
    SELECT *, floor(wanted)::BIGINT AS whole, target - floor(wanted)::BIGINT * source_size AS rest, source_size / n AS mean,
           ((('0x' || substr(md5('mix-1:' || coalesce(doc_id::VARCHAR, '')), 1, 13))::BIGINT)::DOUBLE + 0.5) / 4503599627370496.0 AS u
    FROM wanted
), chances AS (
    SELECT *, greatest(1e-12, least(0.999999, greatest(wanted - whole, 1e-9) * 2 * mean / greatest(mean + size, 1.0::DOUBLE))) AS chance FROM drawn
), running AS (
    SELECT *, sum(size) OVER (PARTITION BY source ORDER BY (u / (1 - u)) / (chance / (1 - chance)), doc_id NULLS FIRST, size
                              ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW) AS upto
    FROM chances
)
SELECT doc_id, source, size, source_size, target,
       least(whole + (upto - size / 2 <= rest AND size > 0)::INT, 3)::BIGINT AS copies,
       (least(whole + (upto - size / 2 <= rest AND size > 0)::INT, 3) * size)::BIGINT AS taken
FROM running
"""

SQL["op10_superminhash"] = r"""
WITH RECURSIVE worded AS (
    SELECT doc_id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x20\x09-\x0D]+') AS w
    FROM documents
), shingled AS (
    SELECT doc_id, CASE WHEN len(w) > 1 THEN list_distinct(list_transform(range(1, len(w)), lambda i: w[i] || ' ' || w[i + 1])) ELSE w END AS s FROM worded
), shingles AS (
    SELECT doc_id, unnest(s) AS x FROM shingled
), shared AS (
    SELECT a.doc_id AS a, b.doc_id AS b, count(*) AS n_both FROM shingles a JOIN shingles b ON a.x = b.x AND a.doc_id < b.doc_id GROUP BY ALL
), links AS (
    SELECT a, b FROM shared JOIN shingled p ON p.doc_id = a JOIN shingled q ON q.doc_id = b WHERE 100 * n_both >= 80 * (len(p.s) + len(q.s) - n_both)
), either AS (
    SELECT a, b FROM links UNION ALL SELECT b, a FROM links
), reach AS (
    SELECT doc_id AS a, doc_id AS b FROM documents UNION SELECT reach.a, either.b FROM reach JOIN either ON reach.b = either.a
), least AS (
    SELECT a AS doc_id, min(b) AS component_id FROM reach GROUP BY a
)
SELECT doc_id, len(s)::BIGINT AS n_shingles, component_id, doc_id = component_id AS kept FROM shingled JOIN least USING (doc_id)
"""

SQL["op11_lexical_search"] = r"""
WITH doc_terms AS (
    SELECT doc_id, unnest(regexp_extract_all(translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
                                             '[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+')) AS term FROM documents
), item_terms AS (
    SELECT item_id, unnest(regexp_extract_all(translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
                                              '[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+')) AS term FROM benchmark
), lengths AS (
    SELECT doc_id, count(*) AS n FROM doc_terms GROUP BY doc_id
), corpus AS (
    SELECT count(*)::BIGINT AS docs, sum(n)::BIGINT AS total FROM lengths
), normed AS (
    SELECT doc_id, 100 - 75 + (75 * n * docs) // total AS m FROM lengths, corpus
), tfs AS (
    SELECT doc_id, term, count(*) AS tf FROM doc_terms GROUP BY ALL
), weights AS (
    SELECT term, floor(1000 * ln((2 * any_value(docs) + 2)::DOUBLE / (2 * count(*) + 1)))::BIGINT AS w FROM tfs, corpus GROUP BY term
), wanted AS (
    SELECT item_id, term, count(*) AS repeats FROM item_terms GROUP BY ALL
), scored AS (
    SELECT item_id, doc_id, sum(repeats * w * ((1000000000 * tf) // (1000 * tf + 8 * m)))::BIGINT AS score
    FROM wanted JOIN weights USING (term) JOIN tfs USING (term) JOIN normed USING (doc_id) GROUP BY ALL
), ranked AS (
    SELECT item_id, (row_number() OVER (PARTITION BY item_id ORDER BY score DESC, doc_id))::INT AS rank, doc_id, score FROM scored WHERE score > 0
)
SELECT * FROM ranked WHERE rank <= 10
"""

SQL["op12_jaccard_join"] = r"""
WITH RECURSIVE worded AS (
    SELECT doc_id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x20\x09-\x0D]+') AS w
    FROM documents
), shingled AS (
    SELECT doc_id, CASE WHEN len(w) > 3 THEN list_distinct(list_transform(range(1, len(w) - 2), lambda i: array_to_string(w[i:i + 3], ' ')))
                        WHEN len(w) > 0 THEN [array_to_string(w, ' ')] ELSE [] END AS s FROM worded
), shingles AS (
    SELECT doc_id, unnest(s) AS x FROM shingled
), shared AS (
    SELECT a.doc_id AS a, b.doc_id AS b, count(*) AS n_both FROM shingles a JOIN shingles b ON a.x = b.x AND a.doc_id < b.doc_id GROUP BY ALL
), links AS (
    SELECT a, b FROM shared JOIN shingled p ON p.doc_id = a JOIN shingled q ON q.doc_id = b WHERE 100 * n_both >= 85 * (len(p.s) + len(q.s) - n_both)
), either AS (
    SELECT a, b FROM links UNION ALL SELECT b, a FROM links
), reach AS (
    SELECT doc_id AS a, doc_id AS b FROM documents UNION SELECT reach.a, either.b FROM reach JOIN either ON reach.b = either.a
), least AS (
    SELECT a AS doc_id, min(b) AS component_id FROM reach GROUP BY a
)
SELECT doc_id, len(s)::BIGINT AS n_shingles, component_id FROM shingled JOIN least USING (doc_id)
"""

# The CRC-32 of the digits of a number, bit by bit (reflected polynomial EDB88320).
CRC32 = """(xor(list_reduce(list_prepend(4294967295, list_transform(string_split({}::VARCHAR, ''), lambda c: ascii(c)::BIGINT)),
    lambda a, b: list_reduce(list_prepend(xor(a, b), [0, 0, 0, 0, 0, 0, 0, 0]::BIGINT[]),
        lambda x, y: CASE WHEN x & 1 = 1 THEN xor(x >> 1, 3988292384) ELSE x >> 1 END)), 4294967295))"""

SQL["op13_prefix_trie"] = f"""
WITH told AS (
    SELECT conv_id, list(struct_pack(r := coalesce(role, ''), t := coalesce(text, ''))
                         ORDER BY turn NULLS FIRST, md5(strlen(coalesce(role, '')) || ':' || coalesce(role, '') || coalesce(text, ''))) AS turns
    FROM conversations WHERE conv_id IS NOT NULL GROUP BY conv_id
), cut AS (
    SELECT c.conv_id, c.turns, b.turns AS lead, ({CRC32.format("c.conv_id")} % 9)::INT AS h
    FROM told c LEFT JOIN told b ON b.conv_id = c.conv_id - c.conv_id % 5
), rebuilt AS (
    SELECT conv_id, list_concat(coalesce(lead, [])[1:h], turns[h + 1:]) AS turns FROM cut
), starts AS (
    SELECT conv_id, turns, unnest(range(0, len(turns) + 1)) AS depth FROM rebuilt
), nodes AS (
    SELECT turns[1:depth] AS path, depth, min(conv_id) AS conv_id, count(*) AS n_convs,
           coalesce(string_agg(conv_id, ',' ORDER BY conv_id) FILTER (len(turns) = depth), '') AS ends
    FROM starts GROUP BY ALL
), children AS (
    SELECT path[1:depth - 1] AS path, count(*) AS n_children FROM nodes WHERE depth > 0 GROUP BY ALL
), placed AS (
    SELECT n.*, coalesce(n_children, 0) AS n_children, CASE WHEN depth > 0 THEN (n_convs - 1) * strlen(n.path[depth].t) ELSE 0 END AS spared
    FROM nodes n LEFT JOIN children c ON c.path = n.path
), subtrees AS (
    SELECT path[1:d] AS path, sum((n_children = 0)::INT) AS n_leaves, sum(spared) AS saved_tokens
    FROM (SELECT *, unnest(range(0, depth + 1)) AS d FROM placed) GROUP BY ALL
)
SELECT n.conv_id, n.depth, p.conv_id AS parent_conv_id, n.n_convs, n.n_children, n_leaves::BIGINT AS n_leaves,
       saved_tokens::BIGINT AS saved_tokens, sha256(n.ends) AS ends_sha256
FROM placed n JOIN subtrees s ON s.path = n.path LEFT JOIN nodes p ON n.depth > 0 AND p.path = n.path[1:n.depth - 1]
"""
