"""The scheduled jobs, each as one function from tables to tables."""
