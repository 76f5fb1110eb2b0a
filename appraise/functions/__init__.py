"""appraise.functions"""
