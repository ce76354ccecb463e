"""The models: cleaned dimensions and facts, marts, dashboard queries, checks and publishing."""
