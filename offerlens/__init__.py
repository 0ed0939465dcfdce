"""Company signals from job offers, listings and web pages, on Spark."""
