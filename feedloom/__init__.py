"""Captured social-feed pages to clean, ordered tables of posts and job listings, on Spark."""
