"""Property graphs: constraint checks, conflict votes, merging and scoring, on a graph made from the star schema.

Entities are customers, nations and order priorities; relationships say where a customer lives and what it depends on.
Layers stand for the parts of a document that a graph was extracted from.  The same statements run in Spark and DuckDB.
"""

from __future__ import annotations

import re
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from leafgraph.plans.dialect import DUCKDB, SPARK, Spark

_TABLES = ("customer", "orders", "nation", "embeddings")

RELATIONS: dict[str, Callable[[Spark], str]] = {
    "entities": lambda d: """
        select cast(c_nationkey as bigint) as doc_id, concat('E_CUSTOMER_', cast(c_custkey as string)) as id, c_name as label, 'table' as layer_id,
               1 + cast(c_custkey % 3 as bigint) as mention_count, 5e-1 + (c_custkey % 5) / 1e1 as confidence from customer
        union all select n_nationkey, concat('E_LOC_', cast(n_nationkey as string)), n_name, 'paragraph', 1, 9e-1 from nation
        union all select n_nationkey, concat('E_loc_', cast(n_nationkey as string)), n_name, 'paragraph', 0, 12e-1 from nation where n_nationkey % 10 = 3""",
    "relationships": lambda d: """
        select cast(c_nationkey as bigint) as doc_id, concat('R_', cast(o_orderkey as string)) as id,
               concat('E_CUSTOMER_', cast(o_custkey as string)) as src,
               case when o_orderkey % 97 = 0 then 'E_LOC_999' when o_orderkey % 89 = 0 then concat('E_CUSTOMER_', cast(o_custkey as string))
                    else concat('E_LOC_', cast(c_nationkey as string)) end as dst,
               case o_orderstatus when 'F' then 'LOCATED_IN' when 'O' then 'DEPENDS_ON' else 'PART_OF' end as relation_type,
               case when o_orderkey % 2 = 0 then 'table' else 'paragraph' end as layer_id,
               3e-1 + (o_orderkey % 7) / 1e1 as confidence, cast(1 + o_orderkey % 4 as bigint) as evidence_tokens,
               case o_orderkey % 3 when 0 then 'python_nlp' when 1 then 'ml_model' else 'llm' end as tier
        from orders join customer on c_custkey = o_custkey""",
    "entity_checks": lambda d: f"""
        select doc_id, id, {d.matches("id", "^E_[A-Z]+_[0-9]+$")} as id_ok, mention_count >= 1 as mentions_ok, confidence between 0 and 1 as confidence_ok
        from entities""",
    "relationship_checks": lambda d: f"""
        select r.doc_id, r.id, {d.matches("r.id", "^R_[0-9]+$")} as id_ok, r.src <> r.dst as no_self_loop, a.id is not null as source_exists,
               b.id is not null as target_exists
        from relationships r left join entities a on a.doc_id = r.doc_id and a.id = r.src left join entities b on b.doc_id = r.doc_id and b.id = r.dst""",
    "predicates": lambda d: f"""
        select r.doc_id, r.id, lower(r.relation_type) as predicate, r.src as agent, r.dst as patient,
               case when o_orderpriority like '1%' then lower(o_orderpriority) end as instrument,
               case when r.dst like 'E_LOC_%' then r.dst end as location, {d.extract("cast(o_orderdate as string)", "^([0-9-]+)", 1)} as time
        from relationships r join orders on concat('R_', cast(o_orderkey as string)) = r.id""",
    "predicate_checks": lambda d: f"""
        select doc_id, id, predicate, {d.matches("predicate", "^[a-z_]+$")} as predicate_ok,
               case when agent is not null then 1 else 0 end + case when patient is not null then 1 else 0 end
               + case when instrument is not null then 1 else 0 end + case when location is not null then 1 else 0 end
               + case when time is not null then 1 else 0 end as argument_count
        from predicates""",
    "mini_topics": lambda d: """
        select cast(c_nationkey as bigint) as doc_id, concat('T_', cast(c_nationkey as string), '_', cast(c_custkey % 4 as string)) as topic_id,
               case when max(c_nationkey) % 9 = 4 and c_custkey % 4 = 1 then '' else concat('segment ', min(c_mktsegment)) end as label,
               cast(min(c_custkey) as bigint) as span_start, cast(max(c_custkey) - case when c_custkey % 4 = 3 then 40 else 0 end as bigint) as span_end,
               5e-1 + count(*) / 1e2 as confidence from customer group by c_nationkey, c_custkey % 4""",
    "mini_topic_checks": lambda d: """
        select doc_id, topic_id, length(label) >= 1 as label_ok, span_end >= span_start as span_ok, confidence between 0 and 1 as confidence_ok
        from mini_topics""",
    "semantic_tree": lambda d: f"""
        select doc_id, concat('D_', cast(doc_id as string)) as node_id, 'document' as level, {d.joined("distinct_layer", "','", "distinct_layer")} as children,
               cast(null as string) as data_ref
        from (select distinct doc_id, concat('D_', cast(doc_id as string), ':', layer_id) as distinct_layer from entities) l group by doc_id
        union all select doc_id, concat('D_', cast(doc_id as string), ':', layer_id), 'layer', '', layer_id from entities group by doc_id, layer_id""",
    "mini_graph_gate": lambda d: """
        select 'V3.1' as check_id, 'critical' as severity, cast(count(case when not label_ok then 1 end) as bigint) as failures from mini_topic_checks
        union all select 'V3.2', 'critical', cast(count(*) as bigint) from (select doc_id, id from entities group by doc_id, id having count(*) > 1) t
        union all select 'V3.3', 'critical', cast(count(case when not (source_exists and target_exists) then 1 end) as bigint) from relationship_checks
        union all select 'V3.4', 'critical', cast(count(case when not span_ok then 1 end) as bigint) from mini_topic_checks
        union all select 'V3.5', 'warning', cast(count(*) as bigint) from semantic_tree c left join (select distinct doc_id from entities) e
                  on e.doc_id = c.doc_id where e.doc_id is null""",
    "cluster_checks": lambda d: f"""
        select concat('TC_', cast(label as string)) as id, count(*) as members, {d.matches("concat('TC_', cast(label as string))", "^TC_[0-9]+$")} as id_ok,
               count(*) >= 1 as members_ok, max({d.size}(embedding)) as embedding_dim from embeddings group by label""",
    # entities of one label in one document are one: each is linked to the first of them
    "coreference": lambda d: """
        select e.doc_id, f.first_id, e.id as second_id from entities e
        join (select doc_id, label, min(id) as first_id from entities group by doc_id, label) f on f.doc_id = e.doc_id and f.label = e.label
        where e.id <> f.first_id""",
    "relation_confidence": lambda d: """
        select r.id, r.confidence * ln(r.evidence_tokens + 1) / ln(m.most + 1) as weighted from relationships r
        join (select doc_id, max(evidence_tokens) as most from relationships group by doc_id) m on m.doc_id = r.doc_id""",
    "graph_totals": lambda d: """
        select e.doc_id, e.entities, coalesce(r.relationships, 0) as relationships
        from (select doc_id, count(*) as entities from entities group by doc_id) e
        left join (select doc_id, count(*) as relationships from relationships group by doc_id) r on r.doc_id = e.doc_id""",
    "scored_relationships": lambda d: """
        select r.*, r.confidence * r.evidence_tokens / m.most as vote,
               r.confidence * case r.tier when 'python_nlp' then 1e0 when 'ml_model' then 95e-2 else 7e-1 end as tier_confidence
        from relationships r join (select doc_id, layer_id, max(evidence_tokens) as most from relationships group by doc_id, layer_id) m
             on m.doc_id = r.doc_id and m.layer_id = r.layer_id""",
    "layer_richness": lambda d: "select doc_id, layer_id, count(*) as richness from entities group by doc_id, layer_id",
    # of relationships of different type between the same ends the best vote stays; then the richer layer, then the type with
    # more predicates, and what still ties stays with less confidence
    "conflict_resolution": lambda d: """
        select doc_id, src, dst, relation_type, id, case when kinds > 1 and ties > 1 then vote * 7e-1 else vote end as score
        from (select v.*, rank() over (partition by doc_id, src, dst order by vote desc, richness desc, predicates desc) as rank,
                     count(*) over (partition by doc_id, src, dst, vote, richness, predicates) as ties, min(kind_count) over (partition by doc_id, src, dst) as kinds
              from (select s.*, max(kind) over (partition by doc_id, src, dst) as kind_count
                    from (select t.*, coalesce(y.richness, 0) as richness, count(*) over (partition by t.doc_id, t.src, t.dst, t.relation_type) as predicates,
                                 dense_rank() over (partition by t.doc_id, t.src, t.dst order by t.relation_type) as kind
                          from scored_relationships t left join layer_richness y on y.doc_id = t.doc_id and y.layer_id = t.layer_id where t.src <> t.dst) s) v) x
        where rank = 1""",
    "merged_entities": lambda d: f"""
        select doc_id, label, min(id) as id, count(*) as members, {d.joined("layer_id", "','", "layer_id")} as layers, avg(confidence) as confidence,
               cast(sum(mention_count) as bigint) as mentions
        from entities group by doc_id, label""",
    "confidence_summary": lambda d: """
        select doc_id, count(*) as n, avg(tier_confidence) as average, count(case when tier_confidence >= 5e-1 then 1 end) as kept
        from scored_relationships group by doc_id""",
    "remapped_relationships": lambda d: """
        select r.doc_id, r.id, coalesce(a.first_id, r.src) as src, coalesce(b.first_id, r.dst) as dst, r.relation_type
        from relationships r left join coreference a on a.doc_id = r.doc_id and a.second_id = r.src
        left join coreference b on b.doc_id = r.doc_id and b.second_id = r.dst""",
    "provenance": lambda d: f"""
        select doc_id, src, dst, {d.joined("layer_id", "','", "layer_id", "id")} as layers, count(*) as relationships
        from relationships group by doc_id, src, dst""",
    # an element's layers; some relationships of the sample are left out, so that the cover has gaps
    "element_provenance": lambda d: f"""
        select doc_id, id, {d.joined("layer_id", "','", "layer_id")} as layers from (
          select distinct doc_id, id, layer_id from entities
          union all select doc_id, id, layer_id from relationships where evidence_tokens <> 4 or layer_id <> 'paragraph') x group by doc_id, id""",
    "provenance_gaps": lambda d: """
        select e.doc_id, e.id, e.kind from (select doc_id, id, 'entity' as kind from entities union all select doc_id, id, 'relationship' from relationships) e
        left join element_provenance p on p.doc_id = e.doc_id and p.id = e.id where p.id is null""",
    "unresolved_conflicts": lambda d: """
        select doc_id, src, dst, cast(count(distinct relation_type) as bigint) as relation_types from conflict_resolution group by doc_id, src, dst
        having count(distinct relation_type) > 1""",
    "global_graph_gate": lambda d: """
        select 'V4.1' as check_id, cast(count(*) as bigint) as failures from (select doc_id, id from merged_entities group by doc_id, id having count(*) > 1) t
        union all select 'V4.2', cast(count(*) as bigint) from unresolved_conflicts
        union all select 'V4.3', cast(count(*) as bigint) from provenance_gaps
        union all select 'V4.4', cast(count(*) as bigint) from confidence_summary s
                  join (select doc_id, count(*) as n, min(tier_confidence) as low, max(tier_confidence) as high from scored_relationships group by doc_id) r
                  on r.doc_id = s.doc_id where r.n <> s.n or s.average < r.low - 1e-9 or s.average > r.high + 1e-9
        union all select 'V4.5', cast(count(case when a.id is null or b.id is null then 1 end) as bigint) from remapped_relationships r
                  left join merged_entities a on a.doc_id = r.doc_id and a.id = r.src left join merged_entities b on b.doc_id = r.doc_id and b.id = r.dst""",
    "graph_gate": lambda d: """
        select 'V4.entities' as check_id, count(case when not (id_ok and mentions_ok and confidence_ok) then 1 end) as failures from entity_checks
        union all select 'V4.relationships', count(case when not (id_ok and no_self_loop and source_exists and target_exists) then 1 end)
        from relationship_checks""",
    "cross_layer_links": lambda d: """
        select a.doc_id, a.id as first_id, b.id as second_id from relationships a join relationships b
        on a.doc_id = b.doc_id and a.dst = b.src and a.id <> b.id and a.layer_id <> b.layer_id""",
    "embedding_cosine": lambda d: f"""
        select a.vec_id, a.label, {d.dot("a.embedding", "c.embedding")} / (sqrt({d.dot("a.embedding", "a.embedding")}) * sqrt({d.dot("c.embedding", "c.embedding")}))
               as similarity
        from embeddings a join (select label, min(vec_id) as first_id from embeddings group by label) f on f.label = a.label
        join embeddings c on c.vec_id = f.first_id""",
    # each vector goes to the seed it is nearest to, whatever its label; as many seeds as labels
    "cluster_members": lambda d: f"""
        select vec_id, concat('TC_', cast(seed as string)) as cluster_id, similarity from (
          select v.vec_id, s.seed, s.similarity, row_number() over (partition by v.vec_id order by s.similarity desc, s.seed) as rank
          from embeddings v join (
            select a.vec_id, f.vec_id as seed, {d.cosine("a.embedding", "f.embedding")} as similarity
            from embeddings a cross join (select c.vec_id, c.embedding from embeddings c join (select label, min(vec_id) as first_id from embeddings group by label) l
                                          on l.first_id = c.vec_id) f) s on s.vec_id = v.vec_id) x
        where rank = 1""",
    "topic_clusters": lambda d: """
        select cluster_id, count(*) as members, min(similarity) as least_similarity, avg(similarity) as average_similarity,
               cast(count(case when similarity >= 5e-1 then 1 end) as bigint) as close_members from cluster_members group by cluster_id""",
    "cluster_entity_gaps": lambda d: """
        select m.cluster_id, m.vec_id from cluster_members m left join (select distinct id from entities) e
        on e.id = concat('E_CUSTOMER_', cast(m.vec_id as string)) where e.id is null""",
}


def _compile(name: str, dialect: Spark) -> str:
    order: list[str] = []

    def visit(n: str) -> None:
        text = RELATIONS[n](dialect)
        for need in RELATIONS:
            if need != n and re.search(rf"(?:from|join)\s+{need}\b", text):
                visit(need)
        if n not in order:
            order.append(n)

    visit(name)
    return "with " + ",\n".join(f"{n} as ({RELATIONS[n](dialect)})" for n in order) + f"\nselect * from {name}"


def _query(name: str) -> Callable[[SparkSession, str], DataFrame]:
    def run(spark: SparkSession, sf_dir: str) -> DataFrame:
        sql = _compile(name, SPARK).replace("{", "{{").replace("}", "}}")
        used = []
        for t in _TABLES:
            if re.search(rf"(?:from|join)\s+{t}\b", sql):
                sql = re.sub(rf"((?:from|join)\s+){t}\b", rf"\1{{{t}}}", sql)
                used.append(t)
        return spark.sql(sql, **{t: spark.read.parquet(f"{sf_dir}/{t}.parquet") for t in used})

    return run


QUERIES: dict[str, tuple[Callable[[SparkSession, str], DataFrame], str]] = {n: (_query(n), _compile(n, DUCKDB)) for n in RELATIONS}
