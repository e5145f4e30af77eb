"""DuckDB SQL of the queries that SQL can express over whole tables.

Written from the rules, not from the Spark code: spreads are exact distinct counts
(no sketches), rejection risks are sums over the binomial terms, and targets come
from a sorted closed form. Fixed values are written out.
"""

from __future__ import annotations

SP = r"\x20\x09-\x0D"


def _text(s: str) -> str:
    return "'" + s.replace("'", "''") + "'"


# Notices of public licences, by SPDX identifier (variants end in -2, -3).
_NOTICES = [
    ('Apache-2.0', 'Licensed under the Apache License, Version 2.0.'),
    ('Apache-2.0-2', 'Licensed under the Apache License, Version 2.0 (the "License"); you may not use this file except in compliance with the License. You may obtain a copy of the License at'),
    ('BSD-3-Clause', 'Redistribution and use in source and binary forms, with or without modification, are permitted provided that the following conditions are met:'),
    ('BSD-3-Clause-2', 'Use of this source code is governed by a BSD-style license that can be found in the LICENSE file.'),
    ('CC-BY-4.0', 'This work is licensed under a Creative Commons Attribution 4.0 International License.'),
    ('CC-BY-4.0-2', 'Licensed under CC BY 4.0.'),
    ('CC-BY-NC-4.0', 'This work is licensed under a Creative Commons Attribution-NonCommercial 4.0 International License.'),
    ('CC-BY-NC-4.0-2', 'Licensed under CC BY-NC 4.0.'),
    ('CC-BY-SA-4.0', 'This work is licensed under a Creative Commons Attribution-ShareAlike 4.0 International License.'),
    ('CC-BY-SA-4.0-2', 'Licensed under CC BY-SA 4.0.'),
    ('CC0-1.0', 'To the extent possible under law, the author has waived all copyright and related or neighboring rights to this work.'),
    ('GPL-2.0', 'This program is free software; you can redistribute it and/or modify it under the terms of the GNU General Public License as published by the Free Software Foundation; either version 2 of the License, or (at your option) any later version.'),
    ('GPL-2.0-2', 'This work is licensed under the GNU General Public License, version 2.'),
    ('GPL-3.0', 'This program is free software: you can redistribute it and/or modify it under the terms of the GNU General Public License as published by the Free Software Foundation, either version 3 of the License, or (at your option) any later version.'),
    ('GPL-3.0-2', 'This work is licensed under the GNU General Public License, version 3.'),
    ('ISC', 'Permission to use, copy, modify, and/or distribute this software for any purpose with or without fee is hereby granted, provided that the above copyright notice and this permission notice appear in all copies.'),
    ('LGPL-3.0', 'This work is licensed under the GNU Lesser General Public License, version 3.'),
    ('MIT', 'Permission is hereby granted, free of charge, to any person obtaining a copy of this software and associated documentation files (the "Software"), to deal in the Software without restriction, including without limitation the rights to use, copy, modify, merge, publish, distribute, sublicense, and/or sell copies of the Software, and to permit persons to whom the Software is furnished to do so, subject to the following conditions:'),
    ('MIT-2', 'Released under the MIT License.'),
    ('MIT-3', 'This project is licensed under the MIT License.'),
    ('MPL-2.0', 'This Source Code Form is subject to the terms of the Mozilla Public License, v. 2.0.'),
    ('Unlicense', 'This is free and unencumbered software released into the public domain.'),
]
_TEMPLATE_ROWS = ", ".join(f"({_text(n)}, {_text(t)})" for n, t in _NOTICES)

OP2 = f"""
WITH raw AS (SELECT rowid AS r, doc_id, coalesce(text, '') AS text FROM (SELECT row_number() OVER () AS rowid, * FROM documents)),
units AS (
  SELECT DISTINCT r, doc_id, trim(regexp_replace(lower(u), '[^\\p{{L}}\\p{{N}}]+', ' ', 'g')) AS u
  FROM (SELECT r, doc_id, unnest(list_concat([text], string_split_regex(text, '\\n[\\x20\\t\\r]*\\n'), string_split(text, chr(10)))) AS u FROM raw)),
sized AS (SELECT r, doc_id, u, string_split(u, ' ') AS w, len(string_split(u, ' ')) - 1 AS n FROM units WHERE u <> ''),
templates AS (
  SELECT name, string_split(t, ' ') AS w, len(string_split(t, ' ')) - 1 AS n
  FROM (SELECT name, trim(regexp_replace(lower(t), '[^\\p{{L}}\\p{{N}}]+', ' ', 'g')) AS t FROM (VALUES {_TEMPLATE_ROWS}) v(name, t))),
tg AS (SELECT name, n, g, count(*) AS c FROM (SELECT name, n, unnest([w[i] || ' ' || w[i + 1] for i in range(1, n + 1)]) AS g FROM templates) GROUP BY ALL),
ug AS (
  SELECT r, u, n, g, count(*) AS c
  FROM (SELECT r, u, n, unnest([w[i] || ' ' || w[i + 1] for i in range(1, n + 1)]) AS g FROM sized
        WHERE n BETWEEN 1 AND 2 * (SELECT max(n) FROM templates)) GROUP BY ALL),
hits AS (
  SELECT r, u, name, 2.0 * sum(least(tg.c, ug.c)) / (any_value(tg.n) + any_value(ug.n)) AS dice
  FROM ug JOIN tg USING (g) GROUP BY r, u, name HAVING dice >= 0.8),
per AS (
  SELECT r, count(*) AS n_units, string_agg(DISTINCT name, ',' ORDER BY name) AS licences, max(dice) AS dice,
         arg_max(name, (dice, -(SELECT count(*) FROM templates t WHERE t.name < hits.name))) AS licence
  FROM hits GROUP BY r)
SELECT doc_id, coalesce(n_units, 0)::BIGINT AS n_units, coalesce(licences, '') AS licences, licence, round(dice, 6) AS dice
FROM raw LEFT JOIN per USING (r)
"""

OP4 = r"""
WITH t AS (
  SELECT conv_id, turn, coalesce(role, '') AS role, coalesce(text, '') AS text FROM conversations
  UNION ALL SELECT * FROM (VALUES (-1, 0, 'user', '</s>[INST] ok [/INST]'), (-1, 1, 'assistant', '</s>[INST] ok [/INST]')) v(a, b, c, d)),
seg AS (
  SELECT *, 8 + length(role) + 8 + length(text) + 7
    + len(regexp_extract_all(role, '[<\[]\\*(\|turn\|>|\|text\|>|\|end\|>|s>|/s>|INST\]|/INST\]|<SYS>>|</SYS>>|\|im_start\|>|\|im_end\|>|\|endoftext\|>)'))
    + len(regexp_extract_all(text, '[<\[]\\*(\|turn\|>|\|text\|>|\|end\|>|s>|/s>|INST\]|/INST\]|<SYS>>|</SYS>>|\|im_start\|>|\|im_end\|>|\|endoftext\|>)')) AS chars,
    row_number() OVER (PARTITION BY conv_id ORDER BY turn NULLS FIRST, role, text) AS k,
    count(*) OVER (PARTITION BY conv_id) AS n
  FROM t),
run AS (SELECT *, sum(chars) OVER (PARTITION BY conv_id ORDER BY k) AS upto FROM seg)
SELECT conv_id, count(*)::BIGINT AS n_turns,
       sha256(string_agg(role || chr(10) || text || chr(10), '' ORDER BY k)) AS turns_sha256,
       length(coalesce(string_agg(text, '' ORDER BY k) FILTER (role = 'assistant'), ''))::BIGINT AS loss_chars,
       sha256(coalesce(string_agg(text, '' ORDER BY k) FILTER (role = 'assistant'), '')) AS loss_sha256,
       (sum(upto) FILTER (role = 'assistant' OR k = n))::BIGINT AS formatted_chars
FROM run GROUP BY conv_id
"""

OP5 = rf"""
WITH d AS (
  SELECT row_number() OVER () AS r, doc_id, coalesce(lang, chr(0)) AS stratum, coalesce(text, '') AS text,
         regexp_extract_all(coalesce(text, ''), '[^{SP}]+') AS w FROM documents),
ln AS (SELECT r, [x for x in string_split(text, chr(10)) if regexp_matches(x, '[^{SP}]')] AS l FROM d),
win AS (SELECT r, i, array_to_string(w[i:i + 7], ' ') AS x FROM (SELECT r, w, unnest(range(1, len(w) - 6)) AS i FROM d WHERE len(w) >= 8)),
dup AS (SELECT r, i FROM (SELECT r, i, count(*) OVER (PARTITION BY r, x) AS c FROM win) WHERE c > 1),
rep AS (SELECT r, sum(least(8, i - before)) AS n FROM (SELECT r, i, lag(i, 1, -100) OVER (PARTITION BY r ORDER BY i) AS before FROM dup) GROUP BY r),
base AS (
  SELECT d.r, doc_id, stratum, len(w)::BIGINT AS n_words, length(regexp_replace(text, '[{SP}]+', '', 'g'))::BIGINT AS word_chars,
         length(regexp_replace(text, '[^#*$%&|<>]', '', 'g'))::BIGINT AS n_symbols, len(l)::BIGINT AS n_lines,
         (len(l) - list_unique(l))::BIGINT AS n_dup_lines, coalesce(rep.n, 0)::BIGINT AS n_repeat_words
  FROM d JOIN ln USING (r) LEFT JOIN rep USING (r)),
judged AS (SELECT *, n_words < 20 OR 100 * n_repeat_words > 30 * n_words AS base_failed FROM base),
ratio AS (
  SELECT r, doc_id, stratum, base_failed, unnest([
    {{'rule': 'symbol', 'v': coalesce(n_symbols / nullif(word_chars, 0), 0)}}, {{'rule': 'dup', 'v': coalesce(n_dup_lines / nullif(n_lines, 0), 0)}},
    {{'rule': 'repeat', 'v': coalesce(n_repeat_words / nullif(n_words, 0), 0)}}, {{'rule': 'length', 'v': coalesce(word_chars / nullif(n_words, 0), 0)}}],
    recursive := true) FROM judged),
cutoffs AS (
  SELECT rule, unnest(list_zip(range(0, len(c)), c), recursive := false) AS sc FROM (VALUES
    ('symbol', [0.5, 0.4, 0.3, 0.2, 0.15, 0.1]::DOUBLE[]), ('dup', [0.9, 0.8, 0.7, 0.6, 0.5, 0.4]::DOUBLE[]),
    ('repeat', [0.25, 0.2, 0.15, 0.1]::DOUBLE[]), ('length', [40, 30, 25, 20, 15]::DOUBLE[])) v(rule, c)),
lab AS (SELECT doc_id, min(quality) AS q FROM labels WHERE doc_id IS NOT NULL AND quality IS NOT NULL GROUP BY doc_id),
seen AS (
  SELECT stratum, rule, sc[1] AS step, sc[2] AS cutoff, count(*) FILTER (q = 1) AS n,
         count(*) FILTER (q = 1 AND v > sc[2]) AS k, count(*) FILTER (q = 0 AND v > sc[2]) AS caught
  FROM ratio JOIN lab USING (doc_id) JOIN cutoffs USING (rule) WHERE NOT base_failed GROUP BY ALL),
tested AS (
  SELECT *, CASE WHEN k >= n * 0.005 THEN 1.0 ELSE list_sum([
      exp(lgamma(n + 1) - lgamma(i + 1) - lgamma(n - i + 1) + i * ln(0.005) + (n - i) * ln(0.995)) for i in range(0, k + 1)]) END
    * (SELECT count(DISTINCT (stratum, rule)) FROM seen) <= 0.05 AS ok FROM seen),
certified AS (
  SELECT *, caught - k AS gain FROM tested a
  WHERE ok AND NOT EXISTS (SELECT 1 FROM tested b WHERE b.stratum = a.stratum AND b.rule = a.rule AND b.step < a.step AND NOT b.ok)),
chosen AS (SELECT stratum, rule, arg_max(cutoff, (gain, -step)) AS cutoff FROM certified WHERE gain > 0 GROUP BY ALL),
broken AS (SELECT DISTINCT r FROM ratio JOIN chosen USING (stratum, rule) WHERE v > cutoff)
SELECT doc_id, n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words, base_failed,
       NOT base_failed AND r NOT IN (SELECT r FROM broken) AS kept
FROM judged
"""

OP7 = rf"""
WITH d AS (SELECT doc_id, text, source, len(regexp_extract_all(coalesce(text, ''), '[^{SP}]+'))::BIGINT AS size FROM documents),
s AS (SELECT source, sum(size)::BIGINT AS source_size FROM d GROUP BY source),
placed AS (SELECT *, [5, 2, 1][(row_number() OVER (ORDER BY source NULLS LAST) - 1) % 3 + 1] AS weight, 3.0::DOUBLE * source_size AS most FROM s),
ordered AS (
  SELECT *, coalesce(sum(most) OVER (ORDER BY most / weight, source ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS used,
         sum(weight) OVER (ORDER BY most / weight, source ROWS BETWEEN CURRENT ROW AND UNBOUNDED FOLLOWING) AS open,
         sum(source_size) OVER () AS total FROM placed),
level AS (SELECT arg_min((total - used)::DOUBLE / open, most / weight) FILTER ((total - used)::DOUBLE / open <= most / weight) AS v FROM ordered),
t AS (SELECT source, source_size, least(most, coalesce((SELECT v FROM level), 1e300) * weight) AS target FROM placed),
rated AS (
  SELECT doc_id, size, source_size, target, CASE WHEN source_size > 0 THEN target / source_size ELSE 0 END AS rate,
         ('0x' || substr(md5('mix:' || coalesce(doc_id::VARCHAR, md5(coalesce(text, '')))), 1, 13))::BIGINT / 4503599627370496.0::DOUBLE AS u
  FROM d JOIN t ON d.source IS NOT DISTINCT FROM t.source)
SELECT doc_id, size, source_size, target, ((floor(rate) + CASE WHEN u < rate - floor(rate) THEN 1 ELSE 0 END) * size)::BIGINT AS taken FROM rated
"""

OP9 = rf"""
WITH d AS (SELECT row_number() OVER () AS r, doc_id, coalesce('=' || source, 'null') AS site, text, string_split(text, chr(10)) AS l FROM documents),
ln AS (SELECT r, doc_id, site, i, l[i] AS raw, trim(l[i], chr(32) || chr(9) || chr(10) || chr(11) || chr(12) || chr(13)) AS line
       FROM (SELECT r, doc_id, site, l, unnest(range(1, len(l) + 1)) AS i FROM d WHERE text IS NOT NULL)),
wide AS (SELECT line, min((doc_id, i)) AS first FROM ln WHERE line <> '' GROUP BY line HAVING count(DISTINCT site) >= 10),
hit AS (SELECT r, i FROM ln JOIN wide USING (line) WHERE (doc_id, i) <> first),
cut AS (SELECT r, count(*) AS n FROM hit GROUP BY r),
rest AS (SELECT ln.r, string_agg(raw, chr(10) ORDER BY i) AS text FROM ln JOIN cut USING (r) WHERE (ln.r, i) NOT IN (SELECT (r, i) FROM hit) GROUP BY ln.r),
done AS (SELECT d.doc_id, len(l) AS n_lines, coalesce(cut.n, 0) AS n_removed, CASE WHEN cut.r IS NULL THEN d.text ELSE coalesce(rest.text, '') END AS text
         FROM d LEFT JOIN cut USING (r) LEFT JOIN rest USING (r))
SELECT doc_id, coalesce(n_lines, 0)::BIGINT AS n_lines, n_removed::BIGINT AS n_removed, length(text)::BIGINT AS chars_left, md5(text) AS text_md5 FROM done
"""

OP11 = rf"""
WITH d AS (SELECT row_number() OVER () AS r, doc_id, coalesce(lang, '') AS part, coalesce(text, '') AS text,
           regexp_extract_all(coalesce(text, ''), '[^{SP}]+') AS w FROM documents),
lab AS (SELECT doc_id, max((quality = 1)::INT) AS good, max((toxic = 1)::INT) AS toxic FROM labels GROUP BY doc_id),
least AS (SELECT text, min(doc_id) AS least FROM d GROUP BY text),
fails AS (
  SELECT part, coalesce(good, 0) AS good, coalesce(toxic, 0) AS toxic,
         [len(w) < 100, 100 * list_unique(w) < 80 * len(w), 100 * length(regexp_replace(text, '[^A-Z]', '', 'g')) > 10 * length(text),
          regexp_matches(text, '[#$%&*|]'), coalesce(doc_id > least, false)] AS f
  FROM d JOIN least USING (text) LEFT JOIN lab USING (doc_id)),
cell AS (SELECT part, f, count(*) AS n, sum(good) AS good, sum(toxic) AS toxic FROM fails GROUP BY part, f),
letters AS (SELECT unnest(range(1, 6)) AS i),
orders AS (
  SELECT row_number() OVER () AS o, [a.i, b.i, c.i, d.i, e.i] AS p FROM letters a, letters b, letters c, letters d, letters e
  WHERE len(list_distinct([a.i, b.i, c.i, d.i, e.i])) = 5),
step AS (SELECT o, list_aggregate(list_transform(p, lambda x: chr(64 + x::INT)), 'string_agg', '') AS filter_order, p, unnest(range(1, 6)) AS step FROM orders),
each AS (
  SELECT part, filter_order, step, p[step] AS x, n, good, toxic, f,
         len(list_filter(p[:step - 1], lambda i: f[i])) > 0 AS gone FROM cell, step),
counts AS (
  SELECT part, filter_order, step, any_value(x) AS x,
         coalesce(sum(n) FILTER (NOT gone AND NOT f[x]), 0) AS kept, coalesce(sum(n) FILTER (NOT gone AND f[x]), 0) AS removed,
         coalesce(sum(n) FILTER (gone AND f[x]), 0) AS redundant,
         coalesce(sum(n) FILTER (f[x] AND len(list_filter(f, lambda b: b)) = 1), 0) AS unique_fails,
         coalesce(sum(good) FILTER (NOT gone AND f[x]), 0) AS good_lost, coalesce(sum(toxic) FILTER (NOT gone AND f[x]), 0) AS toxic_lost
  FROM each GROUP BY part, filter_order, step)
SELECT part, filter_order, step::INT AS step, kept::BIGINT AS kept, removed::BIGINT AS removed, redundant::BIGINT AS redundant, unique_fails::BIGINT AS unique_fails,
       good_lost::BIGINT AS good_lost, toxic_lost::BIGINT AS toxic_lost, (sum(removed) OVER (PARTITION BY part, x))::BIGINT AS shapley
FROM counts
"""

OP12 = """
WITH RECURSIVE v AS (
  SELECT row_number() OVER () AS r, vec_id, list_transform(embedding, lambda x: x::DOUBLE) AS e,
         coalesce(len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0 AND len(list_filter(embedding, lambda x: x <> 0)) > 0, false) AS ok
  FROM embeddings),
link AS (
  SELECT a.r AS a, b.r AS b, a.vec_id AS x, b.vec_id AS y FROM v a JOIN v b ON a.r <> b.r AND a.ok AND b.ok
  WHERE list_inner_product(a.e, b.e) / sqrt(list_inner_product(a.e, a.e) * list_inner_product(b.e, b.e)) >= 0.95),
reach(a, b) AS (SELECT a, b FROM link UNION SELECT reach.a, link.b FROM reach JOIN link ON reach.b = link.a),
least AS (SELECT reach.a AS r, min(v.vec_id) AS least FROM reach JOIN v ON v.r = reach.b GROUP BY reach.a),
n AS (SELECT a AS r, count(*) AS n FROM link GROUP BY a)
SELECT vec_id, coalesce(n, 0)::BIGINT AS n_links, least(vec_id, coalesce(least, vec_id)) AS component_id, vec_id = least(vec_id, coalesce(least, vec_id)) AS kept
FROM v LEFT JOIN least USING (r) LEFT JOIN n USING (r)
"""

OP13 = """
WITH v AS (
  SELECT vec_id, CASE WHEN vec_id % 7 = 0 THEN (label + 1) % 10 ELSE label END AS label, list_transform(embedding, lambda x: floor(256 * x::DOUBLE)) AS e
  FROM embeddings WHERE label IS NOT NULL AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0),
pair AS (
  SELECT a.vec_id AS anchor, b.vec_id AS id, a.label = b.label AS same, list_inner_product(a.e, b.e)::BIGINT AS score
  FROM v a JOIN v b ON a.vec_id <> b.vec_id WHERE a.vec_id % 100 = 0),
positive AS (SELECT anchor, id, score FROM pair WHERE same QUALIFY row_number() OVER (PARTITION BY anchor ORDER BY score DESC, id) <= 5),
fit AS (
  SELECT p.anchor AS anchor_id, p.id AS positive_id, row_number() OVER (PARTITION BY p.anchor, p.id ORDER BY n.score DESC, n.id) AS nth,
         n.id AS negative_id, p.score AS positive_score, n.score AS negative_score
  FROM positive p JOIN pair n ON n.anchor = p.anchor AND NOT n.same AND 80 * p.score <= 100 * n.score AND n.score <= p.score)
SELECT anchor_id, positive_id, nth::INT AS rank, negative_id, positive_score, negative_score FROM fit WHERE nth <= 5
"""

ORACLES = {"op2_license_scan": OP2, "op4_chat_prefixes": OP4, "op5_quality_rules": OP5, "op7_mixing": OP7, "op9_line_dedup": OP9,
           "op11_filter_audit": OP11, "op12_neighbour_descent": OP12, "op13_hard_negatives": OP13}
