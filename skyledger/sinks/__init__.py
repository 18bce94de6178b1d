"""Writers: partitioned batches, fact upserts, marts, releases and exports."""
