"""appraise.operators"""
