"""End-to-end plans: the batch pipeline, the analytics questions and the dashboard panels."""
