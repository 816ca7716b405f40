"""Admission eligibility, reference data and document extraction as Spark jobs."""
