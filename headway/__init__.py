"""Headway: transit timetable and fares analytics as Spark jobs."""
