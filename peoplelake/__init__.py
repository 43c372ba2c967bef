"""Workforce analytics as Spark DataFrame jobs: raw log -> cleaned tables -> aggregate marts -> insights and retrieval."""
