"""Consumer models, metric layer, semantic selections and the project DAG."""
