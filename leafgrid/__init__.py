"""Page-structure analytics and corpus preparation on Spark."""
