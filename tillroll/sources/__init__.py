"""Readers and writers. Every path is any URI the cluster's Hadoop file systems resolve."""
