"""Plans: document assembly from flat tables, the provider pipelines
and the registered query set."""
