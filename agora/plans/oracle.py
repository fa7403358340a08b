"""SQL statements that give the same rows as the registered queries."""

from __future__ import annotations

from agora.catalog import QA, Profile
from agora.plans import fixtures
from agora.plans.closed_form import closed_form_weights

VIEWS = dict(fixtures.SQL)
NEEDS = dict(fixtures.NEEDS)
ORACLE: dict[str, str] = {}


def view(name: str, sql: str, *needs: str) -> None:
    VIEWS[name], NEEDS[name] = sql, list(needs)


def _ordered(names: list[str], done: list[str]) -> list[str]:
    for name in names:
        if name not in done:
            _ordered(NEEDS.get(name, []), done)
            done.append(name)
    return done


def oracle(name: str, sql: str, *needs: str) -> None:
    views = _ordered(list(needs), [])
    head = "with " + ",\n".join(f"{v} as ({VIEWS[v]})" for v in views) + "\n" if views else ""
    ORACLE[name] = head + sql


# Views ---------------------------------------------------------------------

view(
    "scored",
    """select *, ln(1 + reputation) + 3 * ln(1 + gold_badges) + 2 * ln(1 + silver_badges) + ln(1 + bronze_badges) score
       from qa_users""",
    "qa_users",
)
view(
    "qa_labelled",
    """select user_id, display_name,
              cast(score > (select quantile_cont(score, 0.9) from scored) as int) influential
       from scored""",
    "scored",
)
view(
    "qa_feature_rows",
    """select user_id, display_name, influential, coalesce(tq, 0) total_questions, coalesce(aa, 0) accepted_answers
       from qa_labelled
       left join (select user_id, count(question_id) tq from qa_questions group by user_id) using (user_id)
       left join (select user_id, count(*) filter (where is_accepted) aa from qa_answers group by user_id) using (user_id)""",
    "qa_labelled", "qa_questions", "qa_answers",
)
view(
    "activity",
    """select coalesce(p.author, c.author) author, coalesce(p.n, 0) post_count, coalesce(c.n, 0) comment_count,
              coalesce(p.n, 0) + coalesce(c.n, 0) total_activity
       from (select author, count(*) n from forum_posts group by author) p
       full join (select author, count(*) n from forum_comments group by author) c on p.author = c.author""",
    "forum_posts", "forum_comments",
)
view(
    "active_authors",
    """select *, cast(total_activity > (select quantile_cont(total_activity, 0.9) from activity) as int) active
       from activity""",
    "activity",
)
view(
    "posts_labelled",
    "select p.*, coalesce(a.active, 0) active from forum_posts p left join active_authors a using (author)",
    "active_authors", "forum_posts",
)
view(
    "comments_labelled",
    "select c.*, coalesce(a.active, 0) active from forum_comments c left join active_authors a using (author)",
    "active_authors", "forum_comments",
)
view(
    "post_aggregates",
    """select author, avg(score) avg_post_score, cast(sum(num_comments) as bigint) total_comments, max(active) active_posts
       from posts_labelled group by author""",
    "posts_labelled",
)
view(
    "comment_aggregates",
    "select author, avg(score) avg_comment_score, max(active) active_comments from comments_labelled group by author",
    "comments_labelled",
)
view(
    "author_aggregates",
    """select coalesce(p.author, c.author) author, coalesce(avg_post_score, 0) avg_post_score,
              coalesce(total_comments, 0) total_comments, coalesce(active_posts, 0) active_posts,
              coalesce(avg_comment_score, 0) avg_comment_score, coalesce(active_comments, 0) active_comments
       from post_aggregates p full join comment_aggregates c on p.author = c.author""",
    "post_aggregates", "comment_aggregates",
)
view(
    "qa_nodes",
    """select 'user' node_type, cast(user_id as varchar) as key, row_number() over (order by user_id) - 1 idx,
              cast(1 as double) x, influential y from qa_labelled
       union all
       select 'question', cast(question_id as varchar), row_number() over (order by question_id) - 1, score, null
       from (select question_id, max(score) score from qa_questions group by question_id)
       union all
       select 'answer', cast(answer_id as varchar), row_number() over (order by answer_id) - 1, score, null
       from (select answer_id, max(score) score from qa_answers group by answer_id)""",
    "qa_labelled", "qa_questions", "qa_answers",
)
view(
    "qa_edges",
    """select 'user' src_type, 'asks' relation, 'question' dst_type, u.idx src, q.idx dst
       from qa_questions r
       join qa_nodes u on u.node_type = 'user' and u.key = cast(r.user_id as varchar)
       join qa_nodes q on q.node_type = 'question' and q.key = cast(r.question_id as varchar)
       union all
       select 'question', 'accepted_answer', 'answer', q.idx, a.idx
       from qa_questions r
       join qa_nodes q on q.node_type = 'question' and q.key = cast(r.question_id as varchar)
       join qa_nodes a on a.node_type = 'answer' and a.key = cast(r.accepted_answer_id as varchar)
       union all
       select 'user', 'answers', 'answer', u.idx, a.idx
       from qa_answers r
       join qa_nodes u on u.node_type = 'user' and u.key = cast(r.user_id as varchar)
       join qa_nodes a on a.node_type = 'answer' and a.key = cast(r.answer_id as varchar)
       union all
       select 'question', 'has', 'answer', q.idx, a.idx
       from qa_answers r
       join qa_nodes q on q.node_type = 'question' and q.key = cast(r.question_id as varchar)
       join qa_nodes a on a.node_type = 'answer' and a.key = cast(r.answer_id as varchar)""",
    "qa_nodes", "qa_questions", "qa_answers",
)
view(
    "qa_both_ways",
    """select * from qa_edges
       union all
       select dst_type, case relation when 'accepted_answer' then 'rev_accepted' else 'rev_' || relation end,
              src_type, dst, src from qa_edges""",
    "qa_edges",
)
view(
    "qa_prepared",
    """select * from qa_both_ways
       union all
       select 'user', 'self_loop', 'user', idx, idx from qa_nodes where node_type = 'user'""",
    "qa_both_ways", "qa_nodes",
)
view(
    "author_label",
    """select author, max(active) active
       from (select author, active from posts_labelled union all select author, 0 from comments_labelled)
       group by author""",
    "posts_labelled", "comments_labelled",
)
view(
    "forum_nodes",
    """select 'author' node_type, author as key, row_number() over (order by author) - 1 idx,
              cast(row_number() over (order by author) - 1 as double) x, active y from author_label
       union all
       select 'post', post_id, row_number() over (order by cast(post_id as bigint)) - 1, score, null
       from (select post_id, max(score) score from posts_labelled group by post_id)
       union all
       select 'comment', cast(comment_id as varchar), row_number() over (order by comment_id) - 1, score, null
       from (select comment_id, max(score) score from comments_labelled group by comment_id)""",
    "author_label", "posts_labelled", "comments_labelled",
)
view(
    "forum_edges",
    """select 'author' src_type, 'wrote_post' relation, 'post' dst_type, u.idx src, p.idx dst
       from posts_labelled r
       join forum_nodes u on u.node_type = 'author' and u.key = r.author
       join forum_nodes p on p.node_type = 'post' and p.key = r.post_id
       union all
       select 'author', 'wrote_comment', 'comment', u.idx, c.idx
       from comments_labelled r
       join forum_nodes u on u.node_type = 'author' and u.key = r.author
       join forum_nodes c on c.node_type = 'comment' and c.key = cast(r.comment_id as varchar)
       union all
       select 'post', 'has_comment', 'comment', p.idx, c.idx
       from comments_labelled r
       join forum_nodes p on p.node_type = 'post' and p.key = replace(r.post_id, 't3_', '')
       join forum_nodes c on c.node_type = 'comment' and c.key = cast(r.comment_id as varchar)""",
    "forum_nodes", "posts_labelled", "comments_labelled",
)
view(
    "split_users",
    """select key, case when p < round_even(0.1 * n, 0) then 'val'
                        when p < 2 * round_even(0.1 * n, 0) then 'test' else 'train' end split
       from (select key, row_number() over (order by md5('42|' || key)) - 1 p, count(*) over () n
             from qa_nodes where node_type = 'user')""",
    "qa_nodes",
)
view(
    "egos",
    """with recursive walk as (
           select idx seed_id, node_type, idx, 0 hops from qa_nodes where node_type = 'user' and idx % 10 = 7
           union
           select w.seed_id, e.dst_type, e.dst, w.hops + 1
           from walk w join qa_edges e on e.src_type = w.node_type and e.src = w.idx where w.hops < 3)
       select seed_id, node_type, idx, min(hops) hops from walk group by seed_id, node_type, idx""",
    "qa_nodes", "qa_edges",
)
view(
    "score_steps",
    """select prob, count(*) filter (where label = 1) pos, count(*) filter (where label = 0) neg
       from predictions group by prob""",
    "predictions",
)
view(
    "curve",
    """select *, sum(pos) over w tp, sum(neg) over w fp, sum(pos) over () p, sum(neg) over () n,
              lead(pos) over w next_pos, lead(neg) over w next_neg, row_number() over w place
       from score_steps window w as (order by prob desc)""",
    "score_steps",
)
view(
    "class_rates",
    """select c, count(*) filter (where label = c and pred = c) tp, count(*) filter (where label = c) actual,
              count(*) filter (where pred = c) predicted
       from predictions, (select distinct label c from predictions union select distinct pred from predictions)
       group by c""",
    "predictions",
)
view(
    "row_losses",
    """select *, ln(1 + exp(case when label = 1 then z0 - z1 else z1 - z0 end)) loss from predictions""",
    "predictions",
)
view(
    "batch_rows",
    """select epoch, batch_id, avg(r.loss) loss, avg(cast(label = pred as int)) accuracy, any_value(a.auc) auc,
              (coalesce(avg(label) filter (where pred = 1), 0) + coalesce(avg(1 - label) filter (where pred = 0), 0))
              / (cast(max(greatest(label, pred)) = 1 as int) + cast(min(least(label, pred)) = 0 as int)) as precision
       from row_losses r left join (
           select p.batch_id, avg(case when p.prob > q.prob then 1 when p.prob = q.prob then 0.5 else 0 end) auc
           from predictions p join predictions q on p.batch_id = q.batch_id and p.label = 1 and q.label = 0
           group by p.batch_id) a using (batch_id)
       group by epoch, batch_id""",
    "row_losses", "predictions",
)

# Sources and sinks ---------------------------------------------------------

oracle(
    "csv_scan_users",
    """select user_id, display_name, case when user_id % 10 not in (0, 1) then reputation end reputation,
              gold_badges, silver_badges, bronze_badges from qa_users""",
    "qa_users",
)
oracle(
    "csv_inferred_types",
    """select user_id, display_name, case when user_id % 10 not in (0, 1) then reputation end reputation,
              gold_badges, silver_badges, bronze_badges, case when user_id % 4 <> 0 then gold_badges / 2 end half,
              user_id % 2 = 0 even, 'say "' || user_id || '", twice' quoted from qa_users""",
    "qa_users",
)
oracle("table_round_trip", "select * from qa_feature_rows", "qa_feature_rows")
oracle(
    "flatten_user_pages",
    """select user_id, display_name, reputation,
              case when user_id % 7 <> 0 then gold_badges else 0 end gold_badges,
              case when user_id % 7 <> 0 then silver_badges else 0 end silver_badges,
              case when user_id % 7 <> 0 then bronze_badges else 0 end bronze_badges from qa_users""",
    "qa_users",
)
QUESTION_PAGES = """
    select question_id, 'spark,sql' tags, score,
           case when question_id % 5 <> 0 then user_id end user_id,
           case when question_id % 5 <> 0 then case when question_id % 3 = 0 then user_id + 1 else 0 end end reputation,
           case when question_id % 5 <> 0 then 'name ' || cast(user_id as varchar) end display_name,
           accepted_answer_id
    from qa_questions"""
oracle("flatten_question_pages", QUESTION_PAGES, "qa_questions")
oracle("stream_question_pages", QUESTION_PAGES, "qa_questions")
oracle("stream_feed_pages", QUESTION_PAGES, "qa_questions")
oracle(
    "flatten_answer_pages",
    """select answer_id, question_id, case when score > -20 then user_id end user_id,
              case when score > -20 then 'someone' end display_name,
              case when score > -20 then 0 end reputation, is_accepted, score from qa_answers""",
    "qa_answers",
)
FILES = "benchmark conversations customer documents embeddings events labels lineitem nation orders pages part region supplier"
oracle(
    "discover_table_files",
    " union all ".join(f"select '{name}.parquet' as name, cast(1 as bigint) copies" for name in FILES.split()),
)
oracle("graph_store_pruned_read", "select * from qa_edges where relation = 'asks'", "qa_edges")

# Cleaning and projection ---------------------------------------------------

oracle("drop_columns", "select user_id, display_name from qa_users", "qa_users")
oracle(
    "fill_missing",
    "select user_id, case when gold_badges = 1 then 0 else gold_badges end gold_badges from qa_users",
    "qa_users",
)
oracle(
    "drop_incomplete",
    "select question_id, user_id, accepted_answer_id from qa_questions where accepted_answer_id is not null",
    "qa_questions",
)
oracle(
    "coerce_numbers",
    "select user_id, case when user_id % 3 = 1 then cast(reputation as double) else 0 end as value from qa_users",
    "qa_users",
)
oracle("coerce_flags", "select answer_id, score <= -20 or is_accepted is_accepted from qa_answers", "qa_answers")
oracle("strip_post_prefix", "select comment_id, replace(post_id, 't3_', '') post_id from forum_comments", "forum_comments")
oracle(
    "truncate_ids",
    "select question_id, question_id whole from qa_questions where question_id % 4 <> 0",
    "qa_questions",
)
oracle(
    "feature_target_projection",
    "select user_id, total_questions || ',' || accepted_answers x, influential y from qa_feature_rows",
    "qa_feature_rows",
)
oracle(
    "probability_thresholds",
    "select key, cast(prob >= 0.5 as int) tabular, cast(prob > 0.5 as int) graph from predictions",
    "predictions",
)

# Scalar functions ----------------------------------------------------------

oracle("influence_score", "select user_id, round(score, 6) influence_score from scored", "scored")
oracle("row_max", "select user_id, greatest(gold_badges, silver_badges) largest from qa_users", "qa_users")
oracle("activity_sum", "select user_id, gold_badges + bronze_badges total_activity from qa_users", "qa_users")
oracle("relu", "select answer_id, greatest(score, 0) score from qa_answers", "qa_answers")
oracle("softmax_probability", "select key, round(exp(z1) / (exp(z0) + exp(z1)), 6) prob from predictions", "predictions")
oracle(
    "class_weight_ratio",
    """select count(*) filter (where label = 0) neg, count(*) filter (where label = 1) pos,
              round(count(*) filter (where label = 0) / count(*) filter (where label = 1), 6) scale_pos_weight
       from predictions""",
    "predictions",
)

# Labels --------------------------------------------------------------------

oracle("label_influential", "select * from qa_labelled", "qa_labelled")
oracle("label_active", "select * from active_authors", "active_authors")
oracle("propagate_label", "select comment_id, author, active from comments_labelled", "comments_labelled")
oracle("author_labels_from_posts", "select * from author_label", "author_label")
oracle("author_labels_from_all", "select author, active from active_authors", "active_authors")

# Joins ---------------------------------------------------------------------

oracle("join_user_counts", "select user_id, total_questions, accepted_answers from qa_feature_rows", "qa_feature_rows")
oracle("outer_join_author_aggregates", "select * from author_aggregates", "author_aggregates")
oracle("align_activity_counts", "select author, post_count, comment_count from activity", "activity")
oracle("lookup_answer_edges", "select * from qa_edges where relation = 'answers'", "qa_edges")
oracle("induced_subgraph", "select * from qa_edges where src % 3 <> 0 and dst % 3 <> 0", "qa_edges")

# Aggregations --------------------------------------------------------------

oracle(
    "questions_per_user",
    "select user_id, count(question_id) total_questions from qa_questions group by user_id",
    "qa_questions",
)
oracle(
    "accepted_per_user",
    "select user_id, count(*) filter (where is_accepted) accepted_answers from qa_answers group by user_id",
    "qa_answers",
)
oracle("posts_per_author", "select * from post_aggregates", "post_aggregates")
oracle("comments_per_author", "select * from comment_aggregates", "comment_aggregates")
oracle("rows_per_author", "select author, count(*) comment_count from forum_comments group by author", "forum_comments")
oracle(
    "forum_feature_table",
    """select author, avg_post_score, total_comments, avg_comment_score, greatest(active_posts, active_comments) active
       from author_aggregates""",
    "author_aggregates",
)
oracle("qa_feature_table", "select * from qa_feature_rows", "qa_feature_rows")
oracle("influence_quantile", "select count(score) users, round(quantile_cont(score, 0.9), 6) threshold from scored", "scored")

CORRELATED = ["reputation", "gold_badges", "silver_badges", "bronze_badges"]
view(
    "wide_values",
    """select user_id, 'c' || i i_name, cast(user_id * (i + 3) % 101 + gold_badges * (i % 5) as double) v
       from qa_users, (select unnest(range(40)) i) where (user_id + i) % 7 <> 0""",
    "qa_users",
)
oracle(
    "correlation_matrix",
    "select * from ("
    + " union all ".join(
        f"select '{a}' a, '{b}' b, round(corr({a}, {b}), 6) corr"
        " from (select * replace (case when user_id % 5 <> 0 then gold_badges end as gold_badges) from qa_users)"
        for a in CORRELATED
        for b in CORRELATED
    )
    + ")",
    "qa_users",
)

oracle(
    "wide_correlation",
    """select a.i_name a, b.i_name b, round(corr(a.v, b.v), 6) corr from wide_values a join wide_values b using (user_id)
       group by all""",
    "wide_values",
)
oracle("sketched_threshold", "select count(*) n, true close_by from qa_users", "qa_users")

# Samples and sets ----------------------------------------------------------

oracle(
    "first_posts",
    """select * from forum_posts order by author, post_id limit (select count(*) * 2 // 3 from orders)""",
    "forum_posts",
)
oracle(
    "sample_posts",
    """select * from forum_posts order by md5('42|' || post_id), post_id limit (select count(*) * 2 // 3 from orders)""",
    "forum_posts",
)
oracle("all_authors", "select author from forum_posts union select author from forum_comments", "forum_posts", "forum_comments")
oracle(
    "distinct_posts",
    "select post_id, arg_max(score, comment_id) score from forum_comments group by post_id",
    "forum_comments",
)
oracle(
    "ego_seed_nodes",
    "select * from qa_nodes where node_type = 'user' order by md5('42|' || key) limit 5",
    "qa_nodes",
)
oracle("ego_seed_by_index", "select * from qa_nodes where node_type = 'user' and idx = 7", "qa_nodes")

# Positions and batches -----------------------------------------------------

oracle(
    "dense_user_index",
    "select user_id, display_name, row_number() over (order by display_name, user_id) - 1 idx from qa_users",
    "qa_users",
)
oracle(
    "number_comments",
    """select post_id, author, score, row_number() over (order by post_id, author, score) - 1 comment_id
       from forum_comments""",
    "forum_comments",
)
oracle(
    "class_balanced_batches",
    """select user_id, influential, cast(p // 4 as int) batch_id
       from (select user_id, influential,
                    row_number() over (partition by influential order by md5('42|' || user_id), user_id) - 1 p
             from qa_labelled)
       where p < (select min(n // 4) * 4 from (select count(*) n from qa_labelled group by influential))""",
    "qa_labelled",
)


def _hop(frontier: str, hop: int, k: int) -> str:
    """Floyd's draws of ``k`` places below the degree, then the edges at these places."""
    place = "md5(concat_ws('|', '42', f.batch_id, d.relation, d.dst, j))"
    return f"""select a.batch_id, {hop} hop, e.src_type, e.relation, e.dst_type, e.src, e.dst
               from (select f.batch_id, d.dst_type, d.relation, d.dst, unnest(list_reduce(
                            list_prepend([]::bigint[], list_transform(range(greatest(d.degree - {k}, 0), d.degree),
                                lambda j: [j, ('0x' || {place}[1:15])::bigint % (j + 1)])),
                            lambda taken, x: list_append(taken, case when list_contains(taken, x[2]) then x[1] else x[2] end)
                        )) place
                     from {frontier} f join degrees d on d.dst_type = f.node_type and d.dst = f.idx) a
               join placed e on e.dst_type = a.dst_type and e.relation = a.relation and e.dst = a.dst and e.place = a.place"""


view(
    "placed",
    """select *, row_number() over (partition by dst_type, relation, dst order by src) - 1 place from qa_prepared""",
    "qa_prepared",
)
view("degrees", "select dst_type, relation, dst, count(*) degree from qa_prepared group by all", "qa_prepared")
view(
    "hop_seeds",
    """select cast(idx % 4 as int) batch_id, node_type, idx from qa_nodes where node_type = 'user' and y = 1""",
    "qa_nodes",
)
view("hop_one", _hop("hop_seeds", 1, 3), "placed", "degrees", "hop_seeds")
view(
    "hop_new",
    """select distinct batch_id, src_type node_type, src idx from hop_one
       except select * from hop_seeds""",
    "hop_one", "hop_seeds",
)
oracle("sampled_neighbors", "select * from hop_one union all " + _hop("hop_new", 2, 2), "hop_one", "hop_new")

# Graph ---------------------------------------------------------------------

oracle("qa_graph_nodes", "select * from qa_nodes", "qa_nodes")
oracle("qa_graph_edges", "select * from qa_edges", "qa_edges")
oracle("forum_graph_nodes", "select * from forum_nodes", "forum_nodes")
oracle("forum_graph_edges", "select * from forum_edges", "forum_edges")
oracle("qa_reverse_edges", "select * from qa_both_ways", "qa_both_ways")
oracle(
    "forum_reverse_edges",
    """select * from forum_edges
       union all select dst_type, relation || '__reverse', src_type, dst, src from forum_edges""",
    "forum_edges",
)
oracle("target_self_loops", "select * from qa_prepared where relation = 'self_loop'", "qa_prepared")
oracle(
    "node_split",
    """select node_type, n.key, case when node_type = 'user' then s.split end split
       from qa_nodes n left join split_users s on n.key = s.key""",
    "qa_nodes", "split_users",
)
oracle(
    "relation_degrees",
    """select src_type, relation, dst_type, cast(o.edges as bigint) edges, sources, max_out_degree, destinations, max_in_degree
       from (select src_type, relation, dst_type, sum(d) edges, count(*) sources, max(d) max_out_degree
             from (select src_type, relation, dst_type, src, count(*) d from qa_edges group by all) group by all) o
       join (select relation, count(*) destinations, max(d) max_in_degree
             from (select relation, dst, count(*) d from qa_edges group by all) group by all) i using (relation)""",
    "qa_edges",
)
oracle(
    "multigraph_items",
    """select 'node' item, node_type src_type, null relation, null dst_type, idx src, null dst from qa_nodes
       union all select 'edge', src_type, relation, dst_type, src, dst from qa_edges""",
    "qa_nodes", "qa_edges",
)
oracle(
    "relation_catalogue",
    "select src_type, relation, dst_type, count(*) edges, true known from qa_prepared group by all",
    "qa_prepared",
)
oracle("ego_graph_nodes", "select * from egos", "egos")
oracle(
    "ego_graph_edges",
    """select s.seed_id, e.* from qa_edges e
       join egos s on s.node_type = e.src_type and s.idx = e.src
       join egos t on t.seed_id = s.seed_id and t.node_type = e.dst_type and t.idx = e.dst""",
    "egos", "qa_edges",
)



def _two_hops(edges: str, seeds: str) -> str:
    """Nodes within two hops of the seeds, with their least distance."""

    def step(hop: int, reached: str) -> str:
        return f"""select r.seed_id, e.dst_type node_type, e.dst idx, {hop} hops from ({reached}) r
                   join {edges} e on e.src_type = r.node_type and e.src = r.idx"""

    one = step(1, seeds)
    two = step(2, f"select distinct seed_id, node_type, idx from ({one})")
    return f"""select seed_id, node_type, idx, cast(min(hops) as int) hops
               from ({seeds} union all {one} union all {two}) group by all"""


USERS = "select idx seed_id, node_type, idx, 0 hops from qa_nodes where node_type = 'user'"
oracle(
    "ego_sizes_of_all_users",
    f"select seed_id, hops, count(*) nodes from ({_two_hops('qa_edges', USERS)}) group by all",
    "qa_nodes", "qa_edges",
)
oracle("stored_graph_hop", _two_hops("qa_prepared", USERS + " and idx % 10 = 7"), "qa_nodes", "qa_prepared")

# Models --------------------------------------------------------------------

oracle(
    "train_test_rows",
    """select user_id, case when p < ceil(0.2 * n) then 'test' else 'train' end split
       from (select user_id, row_number() over (order by md5('42|' || user_id)) - 1 p, count(*) over () n
             from qa_labelled)""",
    "qa_labelled",
)

PROFILE = Profile(QA)


def _sage_layer(layer: str, features: str, node_type: str, width: int) -> str:
    """One layer for one node type: own values and the mean of every incoming relation, then ReLU."""
    weights = closed_form_weights(PROFILE)
    relations = PROFILE.incoming(node_type)
    means = ", ".join(
        f"avg(f.x{i}) filter (where relation = '{r}') m{s}_{i}" for s, r in enumerate(relations) for i in range(width)
    )
    outputs = []
    for o in range(2):
        terms = []
        for s, r in enumerate(relations):
            terms.append(f"({weights[f'{layer}/{r}/bias'][o]})")
            for i in range(width):
                terms.append(f"({weights[f'{layer}/{r}/neighbor'][o][i]}) * coalesce(m{s}_{i}, 0)")
                terms.append(f"({weights[f'{layer}/{r}/self'][o][i]}) * n.x{i}")
        outputs.append(f"greatest({' + '.join(terms)}, 0) x{o}")
    return f"""select n.node_type, n.idx, {', '.join(outputs)}
        from {features} n left join (
            select e.dst, {means} from qa_prepared e
            join {features} f on f.node_type = e.src_type and f.idx = e.src
            where e.dst_type = '{node_type}' group by e.dst) m on m.dst = n.idx
        where n.node_type = '{node_type}'"""


view(
    "layer_input",
    "select node_type, idx, case when node_type = 'question' then x / 1000 else x end x0 from qa_nodes",
    "qa_nodes",
)
view(
    "layer_one",
    " union all ".join(_sage_layer("conv1", "layer_input", t, 1) for t in PROFILE.node_types),
    "layer_input", "qa_prepared",
)
view("layer_two", _sage_layer("conv2", "layer_one", "user", 2), "layer_one", "qa_prepared")


def _head() -> str:
    weight, bias = (closed_form_weights(PROFILE)[f"head/{n}"] for n in ("weight", "bias"))
    logits = [f"({weight[o][0]}) * x0 + ({weight[o][1]}) * x1 + ({bias[o]}) z{o}" for o in range(2)]
    return f"select idx, {', '.join(logits)} from layer_two"


view("sage_logits", _head(), "layer_two")

# The model at width 64. Its weights follow their formula here too, so each layer is a few sums over lists.
WIDE = 64
NUMBER = {name: n for n, name in enumerate(closed_form_weights(PROFILE, WIDE))}


def _entry(name: str, k: str) -> str:
    return f"((({7 * NUMBER[name]} + 3 * ({k})) % 11 - 4) / 10)"


def _wide_output(layer: str, relations: list[str], width: int) -> str:
    """ReLU of output o: over m<s>, the list of means of relation s, and own, the node's values."""
    terms = []
    for s, r in enumerate(relations):
        terms.append(_entry(f"{layer}/{r}/bias", "o"))
        for part, values in (("neighbor", f"m{s}"), ("self", "own")):
            weights = f"list_transform(range({width}), lambda i: {_entry(f'{layer}/{r}/{part}', f'o * {width} + i')}::double)"
            terms.append(f"list_dot_product({weights}, {values})")
    return f"greatest({' + '.join(terms)}, 0)"


def _wide_means(relations: list[str], width: int, values: str, node_type: str) -> str:
    """Nodes of a type with own and, for each relation, the list of means, zeros without neighbours."""
    sums = f"""select e.dst idx, e.relation, f.i, avg(f.v) m from qa_prepared e join {values} f on f.node_type = e.src_type and f.idx = e.src
               where e.dst_type = '{node_type}' group by all"""
    lists = f"select idx, relation, list(m order by i) m from ({sums}) group by all"
    joins = " ".join(f"left join lists l{s} on l{s}.idx = n.idx and l{s}.relation = '{r}'" for s, r in enumerate(relations))
    columns = ", ".join(f"coalesce(l{s}.m, list_transform(range({width}), lambda i: 0::double)) m{s}" for s in range(len(relations)))
    return f"""with lists as materialized ({lists})
               select n.node_type, n.idx, n.own, {columns} from (
                   select node_type, idx, list(v order by i) own from {values} where node_type = '{node_type}' group by all) n {joins}"""


def _wide_layer(layer: str, values: str, node_type: str, width: int) -> str:
    relations = PROFILE.incoming(node_type)
    return f"""select node_type, idx, o i, {_wide_output(layer, relations, width)} v
               from ({_wide_means(relations, width, values, node_type)}), (select unnest(range({WIDE})) o)"""


view("wide_input", "select node_type, idx, 0::bigint i, x0::double v from layer_input", "layer_input")
view("wide_one", " union all ".join(_wide_layer("conv1", "wide_input", t, 1) for t in PROFILE.node_types), "wide_input", "qa_prepared")
view("wide_two", _wide_layer("conv2", "wide_one", "user", WIDE), "wide_one", "qa_prepared")
oracle(
    "sage_forward_wide",
    "select idx, " + ", ".join(
        f"round(sum({_entry('head/weight', f'{o} * {WIDE} + i')} * v) + {_entry('head/bias', str(o))}, 4) z{o}" for o in range(2)
    ) + " from wide_two group by idx",
    "wide_two",
)
oracle("sage_forward", "select idx, round(z0, 6) z0, round(z1, 6) z1 from sage_logits", "sage_logits")
oracle(
    "sage_test_predictions",
    """select n.key, round(1 / (1 + exp(z0 - z1)), 6) prob, cast(1 / (1 + exp(z0 - z1)) > 0.5 as int) pred, n.y as label,
              round(ln(1 + exp(case when n.y = 1 then z0 - z1 else z1 - z0 end)), 6) loss
       from sage_logits l join qa_nodes n on n.node_type = 'user' and n.idx = l.idx
       join split_users s on s.key = n.key where s.split = 'test'""",
    "sage_logits", "split_users",
)

# Evaluation ----------------------------------------------------------------

oracle(
    "confusion_matrix",
    """select a.c as label, b.c pred, count(p.key) n from class_rates a cross join class_rates b
       left join predictions p on p.label = a.c and p.pred = b.c group by a.c, b.c""",
    "class_rates", "predictions",
)
MACRO = """round(avg(case when actual = 0 then 0 else tp / actual end), 6) recall,
           round(avg(case when predicted = 0 then 0 else tp / predicted end), 6) as precision,
           round(avg(case when actual + predicted = 0 then 0 else 2 * tp / (actual + predicted) end), 6) f1_score,
           round(sum(tp) / sum(actual), 6) accuracy"""
AUC = "(select round(sum(neg * (tp - pos / 2)) / (any_value(p) * any_value(n)), 6) from curve)"
oracle("macro_scores", f"select {MACRO} from class_rates", "class_rates")
oracle(
    "accuracy_and_loss",
    """select round(avg(cast(label = pred as int)), 6) accuracy, round(1 - avg(cast(label = pred as int)), 6) loss
       from predictions""",
    "predictions",
)
oracle("roc_auc", f"select {AUC} auc", "curve")
POINTS = """select cast(null as double) threshold, cast(0 as double) fpr, cast(0 as double) tpr
            union all select round(prob, 6), round(fp / n, 6), round(tp / p, 6) from curve"""
oracle("roc_points", POINTS, "curve")
oracle(
    "roc_points_reduced",
    POINTS + " where place = 1 or next_pos is null or next_pos <> pos or next_neg <> neg",
    "curve",
)
oracle(
    "mean_cross_entropy",
    "select round(avg(loss), 6) loss from (select avg(loss) loss from row_losses group by batch_id)",
    "row_losses",
)
ROUNDED = "round({0}(loss), 6) loss, round({0}(accuracy), 6) accuracy, round({0}(auc), 6) auc, round({0}(precision), 6) as precision"
oracle("batch_scores", f"select epoch, batch_id, {ROUNDED.format('')} from batch_rows", "batch_rows")
oracle("epoch_summary", f"select epoch, {ROUNDED.format('avg')} from batch_rows group by epoch", "batch_rows")
oracle("evaluate_predictions", f"select {MACRO}, {AUC} auc from class_rates", "class_rates", "curve")
