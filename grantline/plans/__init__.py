"""The five pipelines, composed from sources and operators."""
