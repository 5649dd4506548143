"""SQL twins (DuckDB) of the operators that SQL can express on whole tables in fair time (removal of repeated bytes takes minutes there, so tests hold it to brute force)."""

_UPPER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ"

OP1 = """with recursive d as (select doc_id, regexp_extract_all(coalesce(text, ''), '[^ \\t-\\r]+') w from documents where doc_id is not null),
 n as (select doc_id, w, len(w) n from d),
 s as (select doc_id, unnest(range(1, n - 18)) i, w from n where n >= 20),
 g as (select doc_id, i, array_to_string(w[i:i + 19], ' ') t from s),
 f as (select doc_id, i, min(struct_pack(d := doc_id, i := i)) over (partition by t) m from g),
 c as (select distinct doc_id, i + unnest(range(0, 20)) j from f where m <> struct_pack(d := doc_id, i := i)),
 p as (select doc_id, unnest(range(1, n + 1)) j, unnest(w) x from n),
 k as (select doc_id, count(c.j) n_removed, string_agg(case when c.j is null then x end, ' ' order by p.j) kept from p left join c using (doc_id, j) group by 1)
select doc_id, n n_words, coalesce(n_removed, 0) n_removed, sha256(coalesce(kept, '')) kept_sha256 from n left join k using (doc_id)"""

OP4 = """with recursive v as (select vec_id, embedding::double[] x, sqrt(list_dot_product(embedding::double[], embedding::double[])) n from embeddings),
 l as (select a.vec_id a, b.vec_id b from v a join v b on a.vec_id <> b.vec_id where a.n > 0 and b.n > 0 and list_dot_product(a.x, b.x) / (a.n * b.n) >= 0.95),
 r(node, reach) as (select vec_id, vec_id from v union select r.node, l.b from r join l on l.a = r.reach),
 c as (select node, min(reach) component_id from r group by 1)
select vec_id, (select count(*) from l where a = vec_id) n_links, component_id, component_id = vec_id kept from v join c on node = vec_id"""

OP8 = f"""with recursive d as (select doc_id, regexp_extract_all(translate(coalesce(text, ''), '{_UPPER}', '{_UPPER.lower()}'), '[^ \\t-\\r]+') w from documents where doc_id is not null),
 s as (select distinct doc_id, array_to_string(w[i:i + 2], ' ') t from (select doc_id, w, unnest(range(1, greatest(len(w) - 1, 2))) i from d where len(w) > 0)),
 n as (select doc_id, count(*) n from s group by 1),
 o as (select a.doc_id a, b.doc_id b, count(*) m from s a join s b on a.t = b.t and a.doc_id <> b.doc_id group by all),
 l as (select a, b from o join n x on x.doc_id = a join n y on y.doc_id = b where 100 * m >= 85 * (x.n + y.n - m)),
 r(node, reach) as (select doc_id, doc_id from d union select r.node, l.b from r join l on l.a = r.reach),
 c as (select node, min(reach) component_id from r group by 1)
select doc_id, coalesce(n, 0) n_shingles, component_id, component_id = doc_id kept from d left join n using (doc_id) join c on node = doc_id"""

OP10 = """with v as (select vec_id, list_transform(embedding::double[], lambda x: floor(1024 * x)) z from embeddings),
 p as (select a.vec_id query_id, b.vec_id, list_dot_product(a.z, b.z)::bigint score from v a join v b on a.vec_id <> b.vec_id where a.vec_id % 100 = 0),
 r as (select query_id, (row_number() over (partition by query_id order by score desc, vec_id))::int "rank", vec_id, score from p)
select * from r where "rank" <= 10"""

_SAID = r"\### Assistant: </turn> ok"

OP11 = rf"""with c as (select conv_id, turn, coalesce(role, '') "role", coalesce(text, '') text from conversations union all select * from (values (-7, 0, 'user', '{_SAID}'), (-7, 1, 'assistant', '{_SAID}'))),
 e as (select *, replace(replace(text, '\', '\\'), '<|', '<\|') x, replace(replace("role", '\', '\\'), '<|', '<\|') r from c)
select conv_id, count(*) n_turns, sha256(string_agg("role" || chr(10) || text || chr(10), '' order by turn nulls first, "role")) turns_sha256,
 coalesce(sum(length(text)) filter ("role" = 'assistant'), 0)::bigint loss_chars, sha256(coalesce(string_agg(text, '' order by turn nulls first) filter ("role" = 'assistant'), '')) loss_sha256,
 sum(26 + length(r) + length(x))::bigint formatted_chars from e group by 1"""

OP12 = r"""with h as (select doc_id, coalesce(text, '') t, sha256('42:' || coalesce(doc_id::varchar, '')) s from documents),
 u as (select *, regexp_extract_all(t, '[ \t-\r]*[^ \t-\r]+|[ \t-\r]+') w, [('0x' || s[8 * i - 7:8 * i])::ubigint for i in [1, 2, 3, 4]] k from h),
 n as (select *, len(w) n, least(k[1] % (len(w) + 1), k[2] % (len(w) + 1))::bigint a, greatest(k[1] % (len(w) + 1), k[2] % (len(w) + 1))::bigint b,
  case when t = '' or contains(t, '<P>') or contains(t, '<S>') or contains(t, '<M>') or k[3] % 100 >= 50 then 'plain' when k[4] % 100 < 80 then 'spm' else 'psm' end form from u),
 p as (select doc_id, n, form, t, array_to_string(w[:a], '') x, array_to_string(w[a + 1:b], '') y, array_to_string(w[b + 1:], '') z from n)
select doc_id, n, form, case when form <> 'plain' then length(x) end prefix_chars, case when form <> 'plain' then length(y) end middle_chars,
 sha256(case form when 'plain' then t when 'psm' then '<P>' || x || '<S>' || z || '<M>' || y else '<S>' || z || '<P>' || x || '<M>' || y end) output_sha256, sha256(t) restored_sha256 from p"""
