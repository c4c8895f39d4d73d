"""Table enrichment, discovery, search and monitoring as Spark operators."""

from tablerich.functions.sql import enrich_udf, register, unregister
from tablerich.operators.discovery import Condition, Discovery, Enrichment
from tablerich.operators.enrich import Enriched, enrich, enrich_new, enrich_one, enrich_partitioned, typed_job
from tablerich.operators.naming import OutputColumn, derive_name, name_of, output_struct
from tablerich.operators.resolvers import CallableResolver, ExprResolver, TableResolver
from tablerich.operators.search import Corpus, search
from tablerich.plans.jobs import ConfigError, JobConfig, load_config, parse_config, run_job, run_many
from tablerich.session import build_session
from tablerich.streaming.enrichment import batch_enricher, batch_writer, enrich_stream

__all__ = [
    "CallableResolver", "Condition", "ConfigError", "Corpus", "Discovery", "Enriched", "Enrichment", "ExprResolver",
    "JobConfig", "OutputColumn", "TableResolver", "batch_enricher", "batch_writer", "build_session", "derive_name",
    "enrich", "enrich_new", "enrich_one", "enrich_partitioned", "enrich_stream", "enrich_udf", "load_config",
    "name_of", "output_struct", "parse_config", "register", "run_job", "run_many", "search", "typed_job", "unregister",
]
