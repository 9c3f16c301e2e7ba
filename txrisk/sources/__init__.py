"""Readers and writers: transaction tables, day/month partitions, models, run log."""
